"""Entry points: label a table of notes, or a batch of titles.

Note titles repeat: few distinct titles cover most rows. So repeated titles are
scored once and the results go back by a broadcast join, which moves no row.

* A sketch of fixed size names the titles that repeat, without a shuffle by title; as many
  as the limits allow are answered by the join.
* Every row that has no answer then is scored where it stands. Hot titles cost
  nothing, rows are not shuffled, no title is left out.

Only an encoder that is too costly per row needs a shuffle, of the rows that
fail a gate and are not hot; no title among them is frequent, so no task gets
more than a small share. Such rows are kept in the shared folder first, so that
answers belong to the rows that asked, also where the input cannot be read twice alike.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from titlelabels.anchors import anchor_table
from titlelabels.operators.centroids import centroid_library, label_centroids
from titlelabels.operators.hybrid import OUTPUT_SCHEMA, classification, needs_vector, with_classification
from titlelabels.operators.hot import repeated_titles
from titlelabels.operators.rules import rule_sql
from titlelabels.rulepack import RULES, Rule
from titlelabels.session import checkpointed
from titlelabels.sources.encoders import Encoder, HashedTokens
from titlelabels.taxonomy import DIMS, LABELS, Settings

KEY = "__title_key"
FOUND = "__title_found"
AT = "__title_at"

# Titles are looked up by themselves, or by their hash of 64 letters where they are as long.
KEY_BYTES = 64


def result_bytes(rules: tuple[Rule, ...]) -> int:
    """Upper bound for one result of a pack: every tag, every label as result and in its score map."""
    labels = {x for r in rules for d in DIMS for x in r.labels(d)} | {x for d in DIMS for x in LABELS[d]}
    texts = [r.tag for r in rules] + 2 * sorted(labels)
    return 256 + sum(len(t.encode()) + 24 for t in texts) + 8 * len(labels)


@dataclass(frozen=True)
class Limits:
    """What may be broadcast."""

    titles: int = 50_000
    bytes: int = 256 * 1024 * 1024

    def most(self, each: int) -> int:
        """Titles that may be broadcast, at ``each`` bytes a result."""
        return max(1, min(self.titles, self.bytes // (each + KEY_BYTES)))


@dataclass(frozen=True)
class Labeller:
    """Everything a run needs: encoder, centroids, rules, settings and limits.

    ``centroids`` (``dim, label, c``) may be a saved table; by default they are
    computed from the anchors with the encoder.
    """

    encoder: Encoder = HashedTokens()
    centroids: DataFrame | None = None
    anchors: DataFrame | None = None
    rules: tuple[Rule, ...] = RULES
    settings: Settings = Settings()
    limits: Limits = Limits()

    def library(self, df: DataFrame) -> Column:
        centroids = self.centroids
        if centroids is None:
            anchors = self.anchors if self.anchors is not None else anchor_table(df.sparkSession)
            centroids = label_centroids(self.encoder.anchor_vectors(anchors))
        return centroid_library(centroids)

    def score(self, df: DataFrame, title_col: str, out: str, known: str | None = None) -> DataFrame:
        """Add the result as column ``out``; where ``known`` has one already, that is taken and nothing computed."""
        return with_classification(
            df, title_col, self.encoder, self.library(df), self.rules, self.settings, out, known
        )


@dataclass(frozen=True)
class Answers:
    """Results of the repeated titles of a table: ``lookup`` (``__t``, the result, ``n`` rows; None if no title repeats)
    and the number of ``rows`` of the table."""

    lookup: DataFrame | None
    rows: int


def lookup_key(title: str) -> Column:
    """The title, or its hash if it is long; bounded, and a short title never equals a hash."""
    return F.when(F.octet_length(title) < KEY_BYTES, F.col(title)).otherwise(F.sha2(F.col(title), 256))


def title_counts(df: DataFrame, title_col: str) -> DataFrame:
    """Rows per distinct title, counted before the shuffle (``title, n``)."""
    return df.groupBy(F.col(title_col).alias("title")).agg(F.count(F.lit(1)).alias("n"))


def distinct_titles(df: DataFrame, title_col: str) -> DataFrame:
    """:func:`title_counts`, kept on disk.

    What is read back cannot be computed again: filters on results per title
    stay on the titles and are not moved down to the single rows.
    """
    return checkpointed(title_counts(df, title_col))


def answers(df: DataFrame, title_col: str, labeller: Labeller) -> Answers:
    """Score the titles of ``df`` that repeat, as many as may be broadcast; kept in the shared folder."""
    found = repeated_titles(df, title_col, labeller.limits.most(result_bytes(labeller.rules)))
    if not found.count:
        return Answers(None, found.rows)
    scored = labeller.score(found.titles, "title", FOUND)
    return Answers(checkpointed(scored.select(lookup_key("title").alias("__t"), FOUND, "n")), found.rows)


def _answered(rows: DataFrame, known: Answers) -> DataFrame:
    """Rows with the results of repeated titles, null where a title has none."""
    if known.lookup is None:
        return rows.withColumn(FOUND, F.lit(None).cast(OUTPUT_SCHEMA))
    lookup = F.broadcast(known.lookup.drop("n"))
    return rows.join(lookup, lookup_key(KEY) == F.col("__t"), "left").drop("__t")


def _classified(df: DataFrame, title_col: str, labeller: Labeller, known: Answers | None = None) -> DataFrame:
    """``df`` plus the result struct as column FOUND; and AT, where the answers have it."""
    # Inside, the columns carry numbers, so that no name of the caller's can clash.
    names = [f"__c{i}" for i in range(len(df.columns))]
    rows = df.withColumn(KEY, F.col(title_col)).toDF(*names, KEY)
    labeller = replace(labeller, encoder=labeller.encoder.renamed(dict(zip(df.columns, names, strict=True))))
    found = _found(rows, labeller, known)
    added = [FOUND, AT] if AT in found.columns else [FOUND]
    return found.select(*names, *added).toDF(*df.columns, *added)


def _found(rows: DataFrame, labeller: Labeller, known: Answers | None) -> DataFrame:
    if rows.isStreaming or not labeller.encoder.by_title:
        return labeller.score(rows, KEY, FOUND)
    answered = _answered(rows, known or answers(rows, KEY, labeller))
    # Rows without an answer are scored on their own, also where the rows read now are not
    # those that were counted; rows with one evaluate nothing.
    if labeller.encoder.per_row:
        return labeller.score(answered, KEY, FOUND, known=FOUND)
    return _cold_by_join(answered, labeller)


def _cold_by_join(answered: DataFrame, labeller: Labeller) -> DataFrame:
    """Rows not answered yet, for an encoder that works on distinct titles.

    The rows are kept with their rule results and read back: what asks for a vector and what is
    answered are the same rows. Only rows that fail a gate are shuffled, and none of their titles is frequent.
    """
    keep = [c for c in answered.columns if c != FOUND]
    settings = labeller.settings
    rules = f"CASE WHEN {FOUND} IS NULL THEN {rule_sql(KEY, labeller.rules, settings)} END"
    is_open = F.col(FOUND).isNull() & F.expr(needs_vector(KEY, "__rules", settings))
    staged = checkpointed(answered.withColumn("__rules", F.expr(rules)).withColumn("__open", is_open))

    settled = staged.filter(~F.col("__open")).withColumns(
        {"__library": labeller.library(answered), "__vector": F.lit(None).cast("array<double>")}
    )
    by_rules = F.expr(classification(KEY, "__rules", "__vector", "__library", settings, False))
    settled = settled.select(*keep, F.coalesce(F.col(FOUND), by_rules).alias(FOUND))

    unsettled = staged.filter("__open").select(*keep)
    titles = unsettled.select(F.col(KEY).alias("__t")).distinct()
    scored = labeller.score(titles, "__t", FOUND)
    joined = unsettled.join(scored, F.col(KEY) == F.col("__t"), "left").select(*keep, FOUND)
    return settled.unionByName(joined)


# Flat column and the struct field it repeats.
FLAT_COLUMNS = {
    "note_roles": "roles",
    "note_types": "note_types",
    "role_conf": "role_confidence",
    "type_conf": "note_type_confidence",
    "clf_source": "classification_source",
    "rule_hits": "rule_hits",
}


def _flat(rows: DataFrame) -> DataFrame:
    """The struct ``classification`` and the flat columns in place of FOUND."""
    flat = {name: F.col(FOUND)[field] for name, field in FLAT_COLUMNS.items()}
    return rows.withColumns({"classification": F.col(FOUND)} | flat).drop(FOUND)


def classify_notes(
    df: DataFrame, title_col: str = "note_title", labeller: Labeller | None = None, known: Answers | None = None
) -> DataFrame:
    """The rows of ``df`` plus the struct ``classification`` and six flat columns.

    Columns of the same names are overwritten; the number of rows is unchanged. ``known`` may be
    what :func:`answers` gave for the same titles.
    """
    return _flat(_classified(df, title_col, labeller or Labeller(), known))


def classify_arranged(
    df: DataFrame,
    title_col: str,
    labeller: Labeller,
    known: Answers | None,
    arrange: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """:func:`classify_notes` with its rows laid out by ``arrange``, which sees all columns and may shuffle and sort, but adds none.

    A result is several times as wide as a note. So rows with a known title pass ``arrange`` with the title's
    place among the answers alone and get the result behind it, without a join, which would not keep
    their order; other rows carry their result once. All flat columns are taken from it afterwards.
    """
    results = F.array().cast(ArrayType(OUTPUT_SCHEMA))
    if known is not None and known.lookup is not None:
        # One row with as many results as may be broadcast; places are those in its list.
        listed = checkpointed(known.lookup.agg(F.collect_list(F.struct("__t", FOUND, "n")).alias("listed")))
        known = replace(known, lookup=listed.select(F.posexplode("listed").alias(AT, "__one")).select("__one.*", AT))
        results = listed.select(F.col("listed")[FOUND].alias("results")).scalar()
    rows = _classified(df, title_col, labeller, known)
    if AT not in rows.columns:
        rows = rows.withColumn(AT, F.lit(None).cast("int"))
    columns = _flat(rows).drop(AT).columns
    own = [F.col(f"`{c}`") for c in df.columns if c in columns and c not in ("classification", *FLAT_COLUMNS)]
    # Arranged with the flat columns; those that ``arrange`` does not use are gone before it moves a row.
    wide = _flat(rows.withColumn("__carried", F.when(F.col(AT).isNull(), F.col(FOUND))))
    narrow = arrange(wide).select(*own, "__carried", AT)
    found = narrow.withColumn(FOUND, F.coalesce(F.col("__carried"), F.get(results, AT))).drop("__carried", AT)
    return _flat(found).select(*[F.col(f"`{c}`") for c in columns])


def score_titles(df: DataFrame, title_col: str = "title", labeller: Labeller | None = None) -> DataFrame:
    """One row per row of ``df``: the title, then the eight result fields."""
    titles = df.select(F.col(title_col).alias("title"))
    out = _classified(titles, "title", labeller or Labeller())
    return out.select("title", *[F.col(FOUND)[f].alias(f) for f in OUTPUT_SCHEMA.fieldNames()])
