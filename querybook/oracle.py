"""SQL side of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

import json

from querybook import fixtures as fx
from querybook.fixtures import quoted, values_cte
from querybook.queries import SAMPLE_TITLES
from titlelabels.anchors import anchor_rows
from titlelabels.operators.hybrid import OUTPUT_SCHEMA
from titlelabels.rulepack import RE2, RULES, rule_pattern
from titlelabels.taxonomy import DIMS, LABELS, Settings

S = Settings()


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


RULE_DATA = ",\n".join(
    (
        values_cte(
            "rules",
            "rule_id, tag, pattern, veto, weight, phrases, roles, note_types",
            [
                (
                    r.rule_id,
                    quoted(r.tag),
                    quoted(rule_pattern(r, RE2)),
                    quoted(r.veto),
                    f"{r.weight}::DOUBLE",
                    quoted("|".join(r.phrases)),
                    quoted("|".join(r.roles)),
                    quoted("|".join(r.note_types)),
                )
                for r in RULES
            ],
        ),
        values_cte(
            "rule_labels",
            "rule_id, dim, label",
            [(r.rule_id, quoted(d), quoted(x)) for r in RULES for d in DIMS for x in r.labels(d)],
        ),
    )
)
TAXONOMY = values_cte(
    "taxonomy", "dim, ord, label", [(quoted(d), i, quoted(x)) for d in DIMS for i, x in enumerate(LABELS[d])]
)
PHRASES = values_cte(
    "phrases", "dim, label, ord, phrase", [(quoted(d), quoted(x), i, quoted(p)) for d, x, i, p in anchor_rows()]
)

# t(title, n) -> rule stage. Two steps stand in for the look-ahead RE2 lacks: what
# a veto word ends is cut off, and an N keeps the word boundary where it was.
RULE_STAGE = f"""{RULE_DATA},
hits AS (
  SELECT t.title, t.n, r.rule_id, r.tag, r.weight FROM t JOIN rules r ON regexp_matches(
    CASE WHEN r.veto IS NULL THEN upper(t.title)
         ELSE regexp_replace(upper(t.title), '.*MEDICATION', 'N') END, r.pattern)),
weights AS (
  SELECT title, dim, label, list_reduce(list(weight ORDER BY rule_id), lambda a, b: a + b) AS w
  FROM hits JOIN rule_labels USING (rule_id) GROUP BY title, dim, label),
tops AS (SELECT title, dim, max(w) AS top FROM weights GROUP BY title, dim),
band AS (
  SELECT title, dim, string_agg(label, '|' ORDER BY label) AS labels
  FROM weights JOIN tops USING (title, dim) WHERE w >= {S.band_ratio}::DOUBLE * top GROUP BY title, dim),
tags AS (
  SELECT title, string_agg(tag, '|' ORDER BY rule_id) AS tags, count(*)::INTEGER AS n_tags FROM hits GROUP BY title),
ruled AS (
  SELECT t.title, t.n, coalesce(br.labels, '') AS roles, coalesce(bt.labels, '') AS types,
         round(least(coalesce(tr.top, 0), 1.0), 4)::DOUBLE AS role_conf,
         round(least(coalesce(tt.top, 0), 1.0), 4)::DOUBLE AS type_conf,
         coalesce(tags.tags, '') AS tags, coalesce(n_tags, 0) AS n_tags,
         t.title IS NULL OR trim(t.title) = '' AS blank
  FROM t
  LEFT JOIN band br ON br.title = t.title AND br.dim = 'role'
  LEFT JOIN band bt ON bt.title = t.title AND bt.dim = 'type'
  LEFT JOIN tops tr ON tr.title = t.title AND tr.dim = 'role'
  LEFT JOIN tops tt ON tt.title = t.title AND tt.dim = 'type'
  LEFT JOIN tags ON tags.title = t.title),
gated AS (
  SELECT *, role_conf >= {S.rule_conf_thresh}::DOUBLE AS role_done, type_conf >= {S.rule_conf_thresh}::DOUBLE AS type_done
  FROM ruled)"""

TITLE_COUNTS = "t AS (SELECT note_title AS title, count(*) AS n FROM notes GROUP BY note_title)"


def _hashed(name: str, source: str, keys: str, text: str) -> str:
    """Sparse hashed vectors ``<name>(keys, b, x)`` of the texts of ``source``."""
    return f"""{name}_tokens AS (
  SELECT {keys}, unnest(string_split_regex(upper({text}), '[^\\p{{L}}\\p{{N}}]+')) AS token FROM {source}),
{name}_counts AS (
  SELECT {keys}, (('0x' || substr(md5(token), 1, 8))::UBIGINT % 256)::INTEGER AS b, count(*)::DOUBLE AS c
  FROM {name}_tokens WHERE token <> '' GROUP BY {keys}, b),
{name}_norms AS (SELECT {keys}, sqrt(sum(c * c)) AS l FROM {name}_counts GROUP BY {keys}),
{name} AS (SELECT {keys}, b, c / l AS x FROM {name}_counts JOIN {name}_norms USING ({keys}))"""


HASHED_SCORES = f"""{TAXONOMY},
{PHRASES},
{_hashed('pv', 'phrases', 'dim, label, ord', 'phrase')},
sizes AS (SELECT dim, label, count(*) AS k FROM phrases GROUP BY dim, label),
means AS (SELECT dim, label, b, sum(x) / any_value(k) AS c FROM pv JOIN sizes USING (dim, label) GROUP BY dim, label, b),
lengths AS (SELECT dim, label, sqrt(sum(c * c)) AS l FROM means GROUP BY dim, label),
centroids AS (SELECT dim, label, b, c / l AS c FROM means JOIN lengths USING (dim, label)),
todo AS (SELECT title FROM gated WHERE NOT blank AND NOT (role_done AND type_done)),
{_hashed('tv', 'todo', 'title', 'title')},
products AS (
  SELECT title, dim, label, sum(x * c) AS s FROM tv JOIN centroids USING (b) GROUP BY title, dim, label),
scores AS (
  SELECT title AS id, dim, label, ord, coalesce(s, 0) AS s
  FROM (SELECT title, dim, label, ord FROM todo, taxonomy) LEFT JOIN products USING (title, dim, label))"""


def _ranked(threshold: float) -> str:
    return f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY id, dim ORDER BY s DESC, ord) AS place FROM scores),
best AS (
  SELECT * FROM ranked
  WHERE place <= CASE WHEN dim = 'role' THEN {S.top_k_role} ELSE {S.top_k_type} END),
kept AS (SELECT * FROM best WHERE s >= {threshold}::DOUBLE),
found AS (
  SELECT id, dim, string_agg(label, '|' ORDER BY place) AS labels, round_even(max(s), 4) AS conf FROM kept GROUP BY id, dim),
sizes_of AS (
  SELECT id, (count(*) FILTER (dim = 'role'))::INTEGER AS n_role, (count(*) FILTER (dim = 'type'))::INTEGER AS n_type
  FROM scores GROUP BY id)"""


def _merged(id_of: str, extra: str = "") -> str:
    """``merged``: the result per row of ``gated`` (or per vector note)."""
    return f"""merged AS (
  SELECT g.title, {extra} g.n, g.blank,
    CASE WHEN blank THEN 'UNKNOWN' WHEN role_done OR fr.labels IS NULL THEN g.roles ELSE fr.labels END AS roles,
    CASE WHEN blank THEN 'UNKNOWN' WHEN type_done OR ft.labels IS NULL THEN g.types ELSE ft.labels END AS types,
    CASE WHEN blank THEN 0.0 WHEN role_done THEN g.role_conf ELSE coalesce(fr.conf, 0) END::DOUBLE AS role_conf,
    CASE WHEN blank THEN 0.0 WHEN type_done THEN g.type_conf ELSE coalesce(ft.conf, 0) END::DOUBLE AS type_conf,
    CASE WHEN blank THEN 'EMPTY' WHEN role_done AND type_done THEN 'RULES'
         WHEN role_done OR type_done THEN 'RULES+EMBEDDING' ELSE 'EMBEDDING' END AS source,
    CASE WHEN blank THEN '' ELSE g.tags END AS tags,
    CASE WHEN blank OR (role_done AND type_done) THEN 0 ELSE coalesce(z.n_role, 0) END::INTEGER AS n_role_scores,
    CASE WHEN blank OR (role_done AND type_done) THEN 0 ELSE coalesce(z.n_type, 0) END::INTEGER AS n_type_scores
  FROM gated g
  LEFT JOIN found fr ON fr.id = {id_of} AND fr.dim = 'role'
  LEFT JOIN found ft ON ft.id = {id_of} AND ft.dim = 'type'
  LEFT JOIN sizes_of z ON z.id = {id_of})"""


def hashed(notes: str, where: str = "TRUE") -> str:
    """CTEs up to ``out``: every note (all its columns) with its result."""
    return with_(
        notes,
        f"kept_notes AS (SELECT * FROM notes WHERE {where})",
        TITLE_COUNTS.replace("FROM notes", "FROM kept_notes"),
        RULE_STAGE,
        HASHED_SCORES,
        _ranked(S.emb_conf_thresh),
        _merged("g.title"),
        "out AS (SELECT k.*, m.* FROM kept_notes k JOIN merged m ON k.note_title IS NOT DISTINCT FROM m.title)",
    )


def ruled(notes: str) -> str:
    return with_(notes, TITLE_COUNTS, RULE_STAGE)


VECTOR_CENTROIDS = f"""{fx.ANCHOR_VECTORS_SQL},
components AS (
  SELECT dim, label, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS pos FROM anchors),
means AS (SELECT dim, label, pos::INTEGER AS pos, avg(x) AS x FROM components GROUP BY dim, label, pos),
lengths AS (SELECT dim, label, sqrt(sum(x * x)) AS l FROM means GROUP BY dim, label),
units AS (SELECT dim, label, pos, x / l AS x FROM means JOIN lengths USING (dim, label))"""
VECTOR_SCORES = f"""{VECTOR_CENTROIDS},
{TAXONOMY},
cents AS (
  SELECT dim, label, ord, list(x ORDER BY pos) AS c FROM units JOIN taxonomy USING (dim, label) GROUP BY dim, label, ord),
scores AS (
  SELECT vec_id AS id, dim, label, ord, list_inner_product(v, c) / sqrt(list_inner_product(v, v)) AS s FROM vnotes, cents),
{_ranked(fx.VECTOR_THRESHOLD)}"""
VECTORS = with_(fx.VECTOR_NOTES_SQL, VECTOR_SCORES)
VECTOR_HYBRID = with_(
    fx.VECTOR_NOTES_SQL,
    "t AS (SELECT note_title AS title, count(*) AS n FROM vnotes GROUP BY note_title)",
    RULE_STAGE.replace("gated AS (", "gated_titles AS ("),
    VECTOR_SCORES,
    "gated AS (SELECT g.*, v.vec_id FROM vnotes v JOIN gated_titles g ON v.note_title IS NOT DISTINCT FROM g.title)",
    _merged("g.vec_id", "g.vec_id,"),
)

SHARED_HYBRID = VECTOR_HYBRID.replace(fx.VECTOR_NOTES_SQL, fx.SHARED_SQL)
# The model counts letters; anchors have length 1, as every vector that a centroid is made of.
LETTERS_HYBRID = (
    VECTOR_HYBRID.replace(
        fx.VECTOR_NOTES_SQL,
        f"""{fx.COMPOSED_SQL},
vnotes AS (SELECT note_title AS vec_id, note_title, {fx.letters_sql("note_title")} AS v FROM (SELECT DISTINCT note_title FROM notes)),
{PHRASES},
raw AS (SELECT dim, label, {fx.letters_sql("phrase")} AS v FROM phrases)""",
    )
    .replace(
        fx.ANCHOR_VECTORS_SQL,
        "anchors AS (SELECT dim, label, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS v FROM raw)",
    )
    .replace(f"s >= {fx.VECTOR_THRESHOLD}::DOUBLE", f"s >= {fx.LETTERS_THRESHOLD}::DOUBLE")
)

FLAT = "roles, types, role_conf, type_conf, source, tags, n_role_scores, n_type_scores"
ELIGIBLE = "status IN ('COMPLETED', 'AMENDED', 'UNCOSIGNED') AND patient_class IN ('INPATIENT')"
NOTE_FLAT = """roles AS note_roles, types AS note_types, role_conf, type_conf, source AS clf_source, tags AS rule_hits"""


def _list_repr(col: str) -> str:
    return f"CASE WHEN {col} = '' THEN '[]' ELSE '[''' || replace({col}, '|', ''', ''') || ''']' END"


def _pad(text: str, width: int) -> str:
    return f"CASE WHEN length({text}) < {width} THEN rpad({text}, {width}, ' ') ELSE {text} END"


def _anchor_json(dim: str) -> str:
    labels: dict[str, list[str]] = {}
    for d, label, _, phrase in anchor_rows():
        if d == dim:
            labels.setdefault(label, []).append(phrase)
    return json.dumps(dict(sorted(labels.items())), separators=(",", ":"))


def oracle() -> dict[str, str]:
    notes, composed = fx.NOTES_SQL, fx.COMPOSED_SQL
    labels_of = "SELECT dim, unnest(string_split(labels, '|')) AS label FROM (SELECT 'role' AS dim, roles AS labels FROM out UNION ALL SELECT 'type', types FROM out) WHERE labels <> ''"
    types = dict(zip(OUTPUT_SCHEMA.fieldNames(), (f.dataType.simpleString() for f in OUTPUT_SCHEMA.fields), strict=True))
    top = "SELECT id AS vec_id, dim, place::INTEGER AS place, label, round(s, 4) AS score FROM"
    return {
        "scan_notes": with_(notes) + "SELECT * FROM notes",
        "filter_status": with_(notes)
        + "SELECT note_id, status FROM notes WHERE status IN ('COMPLETED', 'AMENDED', 'UNCOSIGNED')",
        "filter_inpatient": with_(notes) + "SELECT note_id, patient_class FROM notes WHERE patient_class = 'INPATIENT'",
        "eligible_notes": with_(notes)
        + f"SELECT sta3n, note_id, note_title, reference_date, status, author_name FROM notes WHERE {ELIGIBLE}",
        "blank_titles": with_(notes)
        + "SELECT note_id, note_title FROM notes WHERE note_title IS NULL OR trim(note_title) = ''",
        "title_upper": with_(composed) + "SELECT note_id, upper(note_title) AS title_upper FROM notes",
        "rule_catalog": ruled(composed)
        + """SELECT rule_id, any_value(r.tag) AS tag, any_value(phrases) AS phrases, any_value(veto) AS veto,
             any_value(roles) AS roles, any_value(note_types) AS note_types, any_value(r.weight) AS weight,
             coalesce(sum(h.n), 0)::BIGINT AS n_notes
             FROM rules r LEFT JOIN hits h USING (rule_id) GROUP BY rule_id""",
        "label_taxonomy": hashed(composed)
        + f"""SELECT dim, ord, label, count(u.label) AS n_notes FROM taxonomy LEFT JOIN ({labels_of}) u
              USING (dim, label) GROUP BY dim, ord, label""",
        "anchor_counts": with_(PHRASES, fx.ANCHOR_VECTORS_SQL)
        + """SELECT dim, label, n_phrases, coalesce(n, 0) AS n_vectors
             FROM (SELECT dim, label, count(*) AS n_phrases FROM phrases GROUP BY dim, label)
             LEFT JOIN (SELECT dim, label, count(*) AS n FROM anchors GROUP BY dim, label) USING (dim, label)""",
        "anchor_export": with_(
            fx.ANCHOR_VECTORS_SQL,
            values_cte("exports", "dim, json", [(quoted(d), quoted(_anchor_json(d))) for d in DIMS]),
        )
        + "SELECT dim, json, count(*) AS n_vectors FROM exports JOIN anchors USING (dim) GROUP BY dim, json",
        "run_manifest": with_(notes, RULE_DATA, TAXONOMY)
        + f"""SELECT {S.rule_conf_thresh}::DOUBLE AS rule_conf_thresh, {S.emb_conf_thresh}::DOUBLE AS emb_conf_thresh,
              (SELECT count(*) FROM rules) AS n_rules,
              (SELECT count(*) FROM taxonomy WHERE dim = 'role') AS n_role_labels,
              (SELECT count(*) FROM taxonomy WHERE dim = 'type') AS n_type_labels,
              'hashed-tokens-256' AS model, count(*) AS n_notes FROM notes WHERE {ELIGIBLE}""",
        "rule_hits_long": ruled(composed) + "SELECT title, rule_id, tag, n FROM hits",
        "rule_hits_array": ruled(composed) + "SELECT title, tags, n_tags FROM ruled",
        "role_weights": ruled(composed) + "SELECT title, label, round(w, 4) AS weight FROM weights WHERE dim = 'role'",
        "type_weights": ruled(composed) + "SELECT title, label, round(w, 4) AS weight FROM weights WHERE dim = 'type'",
        "rule_confidence": ruled(composed) + "SELECT title, role_conf, type_conf FROM ruled",
        "band_labels": ruled(composed) + "SELECT title, roles, types FROM ruled",
        "apply_rules": ruled(notes) + "SELECT title, n, roles, types, role_conf, type_conf, tags FROM ruled",
        "l2_normalize": """WITH e AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x * (1 + vec_id % 7)) AS v FROM embeddings),
            x AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS pos FROM e),
            l AS (SELECT vec_id, sqrt(sum(x * x)) AS l FROM x GROUP BY vec_id)
            SELECT vec_id, round(l, 4)::DOUBLE AS length, pos::INTEGER AS pos, round(x / l, 4) AS x
            FROM x JOIN l USING (vec_id)""",
        "label_centroids": with_(VECTOR_CENTROIDS) + "SELECT dim, label, pos, round(x, 4) AS x FROM means",
        "label_centroids_unit": with_(VECTOR_CENTROIDS) + "SELECT dim, label, pos, round(x, 4) AS x FROM units",
        "encode_titles": with_(composed, TITLE_COUNTS, _hashed("tv", "t", "title", "title"))
        + "SELECT title, b AS bucket, round(x, 4) AS x FROM tv",
        "cosine_scores": VECTORS + "SELECT id AS vec_id, dim, label, round(s, 4) AS score FROM scores",
        "topk_labels": VECTORS + f"{top} best",
        "topk_above_threshold": VECTORS + f"{top} kept",
        "embedding_confidence": VECTORS
        + """SELECT vec_id, coalesce(r.conf, 0)::DOUBLE AS role_conf, coalesce(t.conf, 0)::DOUBLE AS type_conf FROM vnotes
             LEFT JOIN found r ON r.id = vec_id AND r.dim = 'role' LEFT JOIN found t ON t.id = vec_id AND t.dim = 'type'""",
        "score_maps": VECTORS + "SELECT id AS vec_id, dim, label, round_even(s, 4) AS score FROM scores",
        "embedding_classify": VECTORS
        + """SELECT vec_id, coalesce(r.labels, '') AS roles, coalesce(t.labels, '') AS types,
             coalesce(r.conf, 0)::DOUBLE AS role_conf, coalesce(t.conf, 0)::DOUBLE AS type_conf,
             n_role AS n_role_scores, n_type AS n_type_scores FROM vnotes JOIN sizes_of z ON z.id = vec_id
             LEFT JOIN found r ON r.id = vec_id AND r.dim = 'role' LEFT JOIN found t ON t.id = vec_id AND t.dim = 'type'""",
        "stage_gate": ruled(composed) + "SELECT title, role_done, type_done FROM gated",
        "source_rules": ruled(composed) + "SELECT title, roles, types, n FROM gated WHERE role_done AND type_done",
        "needs_embedding": ruled(notes)
        + "SELECT title, role_done, type_done, n FROM gated WHERE NOT blank AND NOT (role_done AND type_done)",
        "merge_labels": VECTOR_HYBRID + "SELECT vec_id, roles, types FROM merged WHERE NOT blank",
        "merge_confidence": VECTOR_HYBRID + "SELECT vec_id, role_conf, type_conf FROM merged WHERE NOT blank",
        "classification_source": VECTOR_HYBRID + "SELECT vec_id, source FROM merged WHERE NOT blank",
        "hybrid_classify": VECTOR_HYBRID + f"SELECT vec_id, title AS note_title, {FLAT} FROM merged",
        "empty_result": hashed(notes) + f"SELECT note_id, note_title, {FLAT} FROM out WHERE source = 'EMPTY'",
        "classify_notes": hashed(composed) + f"SELECT note_id, note_title, {FLAT} FROM out",
        "classify_hot_cold": hashed(fx.NUMBERED_SQL) + f"SELECT note_id, note_title, {FLAT} FROM out",
        "classify_by_column": hashed(composed)
        + f"SELECT note_id, note_title AS heading, author_name AS note_title, {FLAT} FROM out",
        "classify_vector_table": SHARED_HYBRID
        + f"SELECT s.vec_id, s.note_title, {FLAT} FROM snotes s JOIN merged m ON m.title = s.note_title",
        "classify_model_vectors": LETTERS_HYBRID
        + f"SELECT note_id, note_title, {FLAT} FROM notes JOIN merged m ON m.title = note_title",
        "clustered_files": with_(composed) + "SELECT count(*) AS n_notes, 8 AS n_files, 0 AS n_overlaps, true AS balanced FROM notes",
        "z_ordered_files": with_(notes) + "SELECT count(*) AS n_notes, 8 AS n_files, 0 AS n_overlaps, true AS balanced FROM notes",
        "published_run": with_(notes, RULE_DATA, TAXONOMY, PHRASES)
        + f"""SELECT {S.rule_conf_thresh}::DOUBLE AS rule_conf_thresh, {S.emb_conf_thresh}::DOUBLE AS emb_conf_thresh,
              (SELECT count(*) FROM rules) AS n_rules,
              (SELECT count(*) FROM taxonomy WHERE dim = 'role') AS n_role_labels,
              (SELECT count(*) FROM taxonomy WHERE dim = 'type') AS n_type_labels, 'hashed-tokens-256' AS model,
              count(*) AS n_notes, count(*) AS n_read, (SELECT count(DISTINCT (dim, label)) FROM phrases) AS n_anchor_labels
              FROM notes WHERE {ELIGIBLE}""",
        "classify_notes_flat": hashed(notes) + f"SELECT note_id, {NOTE_FLAT} FROM out",
        "classify_line_notes": hashed(fx.BENCH_SQL)
        + """SELECT roles, types, role_conf, type_conf, source, count(*) AS n_notes FROM out
             GROUP BY roles, types, role_conf, type_conf, source""",
        "score_titles": hashed(notes)
        + """SELECT note_title AS title, roles, types AS note_types, role_conf AS role_confidence,
             type_conf AS note_type_confidence, source AS classification_source FROM out""",
        "title_score_rows": hashed(composed)
        + "SELECT id AS title, dim, label, round_even(s, 4)::DOUBLE AS score FROM scores",
        "output_schema": with_(
            notes,
            values_cte(
                "fields", "ord, field, type", [(i, quoted(f), quoted(t)) for i, (f, t) in enumerate(types.items())]
            ),
        )
        + "SELECT ord, field, type, (SELECT count(*) FROM notes) AS n_notes FROM fields",
        "signature_sample": hashed(notes, f"note_title IN ({', '.join(map(quoted, SAMPLE_TITLES))})")
        + """SELECT note_title, roles, types, role_conf, type_conf, source, tags, count(*) AS n_notes FROM out
             GROUP BY note_title, roles, types, role_conf, type_conf, source, tags""",
        "notes_end_to_end": hashed(notes, ELIGIBLE)
        + f"SELECT note_id, sta3n, status, author_name, reference_date, {NOTE_FLAT} FROM out",
        "sink_roundtrip": hashed(notes, ELIGIBLE)
        + "SELECT note_id, roles AS role_key, types AS type_key, role_conf, source AS clf_source FROM out",
        "clustered_layout": hashed(composed)
        + """SELECT roles AS role_key, types AS type_key, source AS clf_source, count(*) AS n_notes FROM out
             GROUP BY roles, types, source""",
        "z_ordered_layout": hashed(notes)
        + "SELECT note_id, roles AS role_key, types AS type_key, source AS clf_source FROM out",
        "smoke_report": hashed(notes)
        + f"""SELECT title, {_pad("substr(coalesce(title, ''), 1, 44)", 45)} || ' ' || {_pad(_list_repr('roles'), 30)}
              || ' ' || {_pad(_list_repr('types'), 40)} || ' ' || {_pad('source', 18)} || ' '
              || printf('%6.3f', role_conf) || ' ' || printf('%6.3f', type_conf) AS line FROM merged""",
        "notes_by_role": hashed(composed)
        + """SELECT note_id, note_title, roles AS note_roles FROM out
             WHERE list_contains(string_split(roles, '|'), 'NURSING')""",
        "notes_by_type_source": hashed(composed)
        + """SELECT note_id, note_title, types AS note_types FROM out
             WHERE list_contains(string_split(types, '|'), 'DISCHARGE') AND source = 'RULES'""",
        "source_mix": hashed(notes)
        + """SELECT source AS clf_source, count(*) AS n_notes, round(count(*) / (SELECT count(*) FROM out), 4) AS share
             FROM out GROUP BY source""",
        "rule_audit": hashed(composed)
        + """SELECT rule_id, any_value(r.tag) AS tag, coalesce(sum(h.n), 0)::BIGINT AS n_notes
             FROM rules r LEFT JOIN hits h USING (rule_id) GROUP BY rule_id""",
        "role_type_matrix": hashed(composed)
        + """SELECT role, note_type, count(*) AS n_notes FROM (
               SELECT role, unnest(string_split(types, '|')) AS note_type FROM (
                 SELECT unnest(string_split(roles, '|')) AS role, types FROM out WHERE roles <> '') WHERE types <> '')
             GROUP BY role, note_type""",
        "unlabelled_titles": hashed(notes)
        + """SELECT title, roles = '' AS no_role, types = '' AS no_type, count(*) AS n_notes FROM out
             WHERE roles = '' OR types = '' GROUP BY title, roles, types""",
    }
