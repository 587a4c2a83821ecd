"""Notes and vectors derived from the given tables, once for Spark and once as SQL.

Every row of the source table is used; the numbers taken modulo choose a title
for a row, they never drop one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlelabels.taxonomy import ROLE, ROLE_LABELS, TYPE, TYPE_LABELS

# Titles that a report of the job prints.
PRINTED_TITLES = (
    "NURSING PROGRESS NOTE",
    "PHYSICIAN H&P",
    "PHYSICAL THERAPY EVALUATION",
    "SOCIAL WORK DISCHARGE PLANNING NOTE",
    "DISCHARGE SUMMARY",
    "RESPIRATORY THERAPY NOTE",
    "NUTRITION ASSESSMENT",
    "PHARMACY MEDICATION RECONCILIATION",
    "CONSULT NOTE - CARDIOLOGY",
    "VERBAL ORDER CONFIRMATION",
    "PATIENT EDUCATION - DIABETES",
    "ADDENDUM TO PROGRESS NOTE",
    "SURGICAL OPERATIVE REPORT",
    "INTERDISCIPLINARY ROUNDING NOTE",
    "CRITICAL CARE DAILY",
    "BEHAVIORAL HEALTH NOTE",
    "COMMUNITY LIVING CENTER NOTE",
    "WOMEN'S HEALTH NOTE",
    "TELEHEALTH VISIT",
    "PEER SUPPORT SPECIALIST NOTE",
    "",
    "NOTE",
    "MISC CLINICAL DOCUMENTATION",
)
# 64 titles; the place in the list is the title id.
TITLES: tuple[str | None, ...] = (
    *PRINTED_TITLES,
    "IV ACCESS NOTE - PSYCHIATRY MEDICINE",
    "MEDICINE SERVICE MEDICATION REVIEW",
    "MEDICATION REVIEW BY MEDICINE",
    "MEDICINE, MEDICATION, MEDICINE",
    "P.T.EVAL",
    "P.T. NOTE",
    "PHQ-9 SCREENING",
    "PHQ-15",
    "CAREPLAN",
    "Attending / Rn Shift Note",
    None,
    "   ",
    "MICU RESIDENT MD",
    "Palliative Care - Case Manager",
    "NURSE FLOW SHEET",
    "FALL RISK (BRADEN)",
    "WOUND CARE",
    "HOMELESSNESS SCREEN",
    "PSYCHOSOCIAL INTAKE",
    "ADVANCE DIRECTIVE",
    "AUDIT ALCOHOL SCREEN",
    "OCCUPATIONAL THERAPIST NOTE",
    "SPEECH SWALLOW STUDY",
    "SOCIAL WORK CONSULTATION",
    "CHAPLAIN / AUDIOLOGY HEARING TEST",
    "KINESIOTHERAPY",
    "MEDICAL RECORDS TRANSCRIPTION",
    "INFORMED CONSENT / CODING",
    "INITIAL ASSESSMENT ADMIT",
    "soap",
    "SUICIDE RISK",
    "LUMBAR PUNCTURE PROCEDURE",
    "REFERRAL",
    "SBAR END-OF-SHIFT",
    "AFTER VISIT SUMMARY",
    "LATE ENTRY",
    "INCIDENT REPORT",
    "RISK ASSESSMENT",
    "H/P",
    "DC PLANNING",
    "T.O.READ-BACK",
)

SERVICES = (
    "MEDICINE", "NURSING", "SURGERY", "PSYCHIATRY", "CARDIOLOGY", "PALLIATIVE", "MICU", "SOCIAL WORK",
    "CASE MANAGEMENT", "PHYSICAL THERAPY", "OCCUPATIONAL THERAPY", "RESPIRATORY THERAPY", "NUTRITION", "PHARMACY",
    "SPEECH", "AUDIOLOGY", "CHAPLAIN", "MEDICAL RECORDS", "IV", "TELEHEALTH", "COMMUNITY LIVING CENTER",
    "Behavioral Health", "WOUND CARE", "DISCHARGE",
)
KINDS = (
    "PROGRESS NOTE", "ASSESSMENT", "EVALUATION", "CONSULT", "CARE PLAN", "PROCEDURE NOTE", "SHIFT NOTE", "HANDOFF",
    "DISCHARGE SUMMARY", "PLANNING", "ADDENDUM", "H&P", "ADMISSION", "SOAP", "SCREEN", "PHQ-9", "SUICIDE RISK",
    "TREATMENT PLAN", "OPERATIVE REPORT", "BIOPSY", "REFERRAL", "SBAR", "AFTER VISIT SUMMARY", "VERBAL ORDER",
    "PATIENT EDUCATION", "CONSENT FORM", "INCIDENT REPORT", "VISIT", "NOTE", "MEDICATION REVIEW",
)
SUFFIXES = ("", " - ADDENDUM", " (LATE ENTRY)", " RN", " MD", " ICU", " AUDIT")

STATUS_NAMES = ("COMPLETED", "AMENDED", "UNCOSIGNED", "UNSIGNED", "RETRACTED")
CLASS_NAMES: tuple[str | None, ...] = ("INPATIENT", "OUTPATIENT", None)

# Threshold for the stand-in vectors, whose cosines are small.
VECTOR_THRESHOLD = 0.20


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(values: tuple[str | None, ...], number: Column) -> Column:
    """The ``number`` modulo length-th of the values."""
    literals = F.array(*[F.lit(v).cast("string") for v in values])
    return F.get(literals, F.pmod(number, F.lit(len(values))).cast("int"))


def _note_columns(title: Column) -> list[Column]:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    return [
        (F.lit(500) + F.pmod(customer, F.lit(25))).cast("int").alias("sta3n"),
        key.alias("note_id"),
        title.alias("note_title"),
        F.col("o_orderdate").alias("reference_date"),
        pick(STATUS_NAMES, key).alias("status"),
        F.format_string("Customer#%09d", customer).alias("author_name"),
        pick(CLASS_NAMES, customer).alias("patient_class"),
    ]


def as_notes(orders: DataFrame) -> DataFrame:
    """One note per order, titles from the list of 64."""
    return orders.select(*_note_columns(pick(TITLES, F.col("o_orderkey"))))


def notes(spark: SparkSession, folder: str) -> DataFrame:
    return as_notes(read(spark, folder, "orders"))


def composed_title() -> Column:
    return F.concat(
        pick(SERVICES, F.col("o_custkey")),
        F.lit(" "),
        pick(KINDS, F.col("o_orderkey")),
        pick(SUFFIXES, F.col("o_orderkey")),
    )


def composed_notes(spark: SparkSession, folder: str) -> DataFrame:
    """One note per order, with thousands of distinct titles."""
    return read(spark, folder, "orders").select(*_note_columns(composed_title()))


def bench_notes(spark: SparkSession, folder: str) -> DataFrame:
    """One note per line item."""
    return read(spark, folder, "lineitem").select(pick(TITLES, F.col("l_orderkey")).alias("note_title"))


def vector_notes(spark: SparkSession, folder: str) -> DataFrame:
    """One note per embedding, its vector beside the title: ``vec_id, note_title, v``."""
    return read(spark, folder, "embeddings").select(
        "vec_id",
        pick(TITLES, F.col("vec_id")).alias("note_title"),
        scaled_vector().alias("v"),
    )


def scaled_vector() -> Column:
    """The embedding times 1 to 7, since vectors need not have length 1."""
    return F.expr("transform(cast(embedding AS array<double>), x -> x * (1 + vec_id % 7))")


SHARED_TITLE = "TELEHEALTH VISIT"
LETTERS_THRESHOLD = 0.85


def own_title() -> Column:
    return F.concat(pick(SERVICES, F.col("vec_id")), F.lit(" VISIT "), F.col("vec_id").cast("string"))


def shared_notes(spark: SparkSession, folder: str) -> DataFrame:
    """A note with a title of its own per embedding; every second one has a note with the one shared title too."""
    titles = F.when(F.col("vec_id") % 2 == 0, F.array(own_title(), F.lit(SHARED_TITLE))).otherwise(F.array(own_title()))
    return read(spark, folder, "embeddings").select("vec_id", F.explode(titles).alias("note_title"))


def title_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The vector of every title of :func:`shared_notes`: ``title, v``; the shared title has that of embedding 0."""
    vectors = read(spark, folder, "embeddings").select("vec_id", own_title().alias("title"), scaled_vector().alias("v"))
    return vectors.select("title", "v").unionByName(vectors.where("vec_id = 0").select(F.lit(SHARED_TITLE).alias("title"), "v"))


def numbered_title() -> Column:
    own = F.concat_ws(" ", pick(SERVICES, F.col("o_custkey")), pick(KINDS, F.col("o_orderkey")), F.col("o_orderkey").cast("string"))
    return F.when(F.col("o_orderkey") % 5 < 2, SHARED_TITLE).otherwise(own)


def numbered_notes(spark: SparkSession, folder: str) -> DataFrame:
    """One note per order: two fifths with one title, the others with a title of their own."""
    return read(spark, folder, "orders").select(*_note_columns(numbered_title()))


def anchor_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding as an anchor of one role and one note type: ``dim, label, v``."""
    by_dim = F.array(
        F.struct(F.lit(ROLE).alias("dim"), pick(ROLE_LABELS, F.col("label")).alias("name")),
        F.struct(F.lit(TYPE).alias("dim"), pick(TYPE_LABELS, F.col("label")).alias("name")),
    )
    return read(spark, folder, "embeddings").select(
        F.inline(by_dim), F.col("embedding").cast("array<double>").alias("v")
    ).withColumnRenamed("name", "label")


# --- the same as SQL -------------------------------------------------------------------


def quoted(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def values_cte(name: str, columns: str, rows: list[tuple]) -> str:
    body = ",\n".join("(" + ", ".join(str(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def _list_sql(values: tuple[str | None, ...], number: str) -> str:
    return f"([{', '.join(quoted(v) for v in values)}])[({number} % {len(values)}) + 1]"


def _notes_sql(name: str, title: str) -> str:
    return f"""{name} AS (
  SELECT (500 + o_custkey % 25)::INTEGER AS sta3n, o_orderkey AS note_id, {title} AS note_title,
         o_orderdate AS reference_date, {_list_sql(STATUS_NAMES, 'o_orderkey')} AS status,
         printf('Customer#%09d', o_custkey) AS author_name, {_list_sql(CLASS_NAMES, 'o_custkey')} AS patient_class
  FROM orders)"""


NOTES_SQL = _notes_sql("notes", _list_sql(TITLES, "o_orderkey"))
COMPOSED_SQL = _notes_sql(
    "notes",
    f"{_list_sql(SERVICES, 'o_custkey')} || ' ' || {_list_sql(KINDS, 'o_orderkey')} || "
    f"{_list_sql(SUFFIXES, 'o_orderkey')}",
)
NUMBERED_SQL = _notes_sql(
    "notes",
    f"CASE WHEN o_orderkey % 5 < 2 THEN {quoted(SHARED_TITLE)} ELSE {_list_sql(SERVICES, 'o_custkey')} || ' ' || "
    f"{_list_sql(KINDS, 'o_orderkey')} || ' ' || o_orderkey END",
)
_OWN = f"{_list_sql(SERVICES, 'vec_id')} || ' VISIT ' || vec_id"
_SCALED = "list_transform(embedding::DOUBLE[], lambda x: x * (1 + vec_id % 7))"
SHARED_SQL = f"""snotes AS (
  SELECT vec_id, unnest(CASE WHEN vec_id % 2 = 0 THEN [{_OWN}, {quoted(SHARED_TITLE)}] ELSE [{_OWN}] END) AS note_title
  FROM embeddings),
vnotes AS (
  SELECT {_OWN} AS vec_id, {_OWN} AS note_title, {_SCALED} AS v FROM embeddings
  UNION ALL SELECT {quoted(SHARED_TITLE)}, {quoted(SHARED_TITLE)}, {_SCALED} FROM embeddings WHERE vec_id = 0)"""


def letters_sql(text: str) -> str:
    count = f"length(lower({text})) - length(replace(lower({text}), chr((97 + i)::INTEGER), ''))"
    return f"list_transform(range(26), lambda i: ({count})::DOUBLE)"


BENCH_SQL = f"notes AS (SELECT {_list_sql(TITLES, 'l_orderkey')} AS note_title FROM lineitem)"
VECTOR_NOTES_SQL = (
    f"vnotes AS (SELECT vec_id, {_list_sql(TITLES, 'vec_id')} AS note_title, list_transform(embedding::DOUBLE[], lambda x: x * (1 + vec_id % 7)) AS v FROM embeddings)"
)
ANCHOR_VECTORS_SQL = f"""anchors AS (
  SELECT 'role' AS dim, {_list_sql(ROLE_LABELS, 'label')} AS label, embedding::DOUBLE[] AS v FROM embeddings
  UNION ALL
  SELECT 'type', {_list_sql(TYPE_LABELS, 'label')}, embedding::DOUBLE[] FROM embeddings)"""
