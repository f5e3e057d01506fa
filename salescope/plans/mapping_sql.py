"""Oracle SQL of the column mapping: rule scores from the profiles, the one-to-one assignment, its report and accuracy."""
from __future__ import annotations

from .. import schema as S
from ..operators import profile as P
from ..sources import fixtures as FX
from .ingest_sql import PROFILE_COLUMNS, _profile_tables
from .oracle import _r
from .schema_inference import ALIGNED


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _scores() -> str:
    """score(source_file, column, field number, field, confidence, units)."""
    speaks = dict(P.RULE_FEATURES) | {
        "sale_date": "greatest(pct_date, pct_excel_serial)",
        "customer_name": "CASE WHEN pct_num < 0.1 AND mean_len > 8 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"}
    each = " UNION ALL ".join(
        f"""SELECT source_file, "column", {k} AS f, '{f}' AS field, ROUND6({P.RULE_HEADER_WEIGHT}::DOUBLE * hdr_{f}
            + {P.RULE_CONTENT_WEIGHT}::DOUBLE * {speaks[f]}) AS confidence FROM profiles""" for k, f in enumerate(S.FIELDS))
    return _r(f"profiles AS MATERIALIZED ({{PROFILES}}),\nscore AS MATERIALIZED (SELECT *, "
              f"CAST(floor(confidence * {P.SCORE_UNIT} + 0.5) AS BIGINT) AS units FROM ({each}))"
              ).replace("{PROFILES}", PROFILE_COLUMNS)


def _assignment() -> str:
    """mapping(source_file, field, column, confidence): the fold over a file's columns, written out column by column."""
    n, widest = len(S.FIELDS), max(len(cols) for _, _, cols in _profile_tables())
    none = "[" + ", ".join(["1000000"] * n) + "]"
    steps = "".join(f"""
w{k + 1} AS MATERIALIZED (
  SELECT source_file, fields, min({{'less': less, 'pick': pick}}) AS best FROM (
    SELECT source_file, fields, best.less AS less, best.pick AS pick FROM w{k}
    UNION ALL
    SELECT w.source_file, w.fields + (1 << s.f), w.best.less - s.units,
           list_concat(list_concat(w.best.pick[1:s.f], [{k}]), w.best.pick[s.f + 2:])
    FROM w{k} w JOIN numbered c ON c.source_file = w.source_file AND c.i = {k}
    JOIN score s ON s.source_file = c.source_file AND s."column" = c."column" WHERE (w.fields >> s.f) % 2 = 0)
  GROUP BY source_file, fields),""" for k in range(widest))
    return f"""
numbered AS (SELECT source_file, "column", row_number() OVER (PARTITION BY source_file ORDER BY "column") - 1 AS i
             FROM (SELECT DISTINCT source_file, "column" FROM score)),
w0 AS (SELECT DISTINCT source_file, 0 AS fields, {{'less': 0::BIGINT, 'pick': {none}}} AS best FROM score),{steps}
chosen AS (SELECT source_file, min(best) AS best FROM w{widest} GROUP BY source_file),
picked AS (SELECT source_file, unnest(generate_series(0, {n - 1})) AS f, unnest(best.pick) AS i FROM chosen),
mapping AS (
  SELECT p.source_file, s.field, c."column", s.confidence FROM picked p
  JOIN numbered c ON c.source_file = p.source_file AND c.i = p.i
  JOIN score s ON s.source_file = c.source_file AND s."column" = c."column" AND s.f = p.f
  WHERE s.confidence >= {S.MAPPING_THRESHOLD})"""


_MAPPING = f"WITH {_scores()},{_assignment()}"
_CONFIDENCE = _r("ROUND3(confidence)")
MAP_COLUMNS = f'{_MAPPING}\nSELECT source_file, field, "column", {_CONFIDENCE} AS confidence FROM mapping'

_FILES = ", ".join(f"('{name}')" for name, _, _ in _profile_tables())
_FIELDS = ", ".join(f"({k}, '{f}')" for k, f in enumerate(S.FIELDS))
MAPPING_REPORT = f"""{_MAPPING}
SELECT s.source_file, f.field_order, f.field, coalesce(m."column", 'not detected') AS "column", m.confidence,
       CASE WHEN m.confidence > {S.CONFIDENCE_HIGH} THEN 'high' WHEN m.confidence > {S.CONFIDENCE_MEDIUM} THEN 'medium'
            WHEN m.confidence IS NOT NULL THEN 'low' END AS band
FROM (VALUES {_FILES}) s(source_file) CROSS JOIN (VALUES {_FIELDS}) f(field_order, field)
LEFT JOIN (SELECT source_file, field, "column", {_CONFIDENCE} AS confidence FROM mapping) m
  ON m.source_file = s.source_file AND m.field = f.field
"""


def _truths() -> str:
    renamed = dict(FX.renamed_headers("source_b.csv"))
    rows = [(name, f, c) for name, _, headers in FX.SOURCES for f, c in headers.items()]
    rows += [("source_b_renamed.csv", f, renamed[c]) for f, c in FX.SOURCE_B_HEADERS.items()]
    return ", ".join(f"({_text(a)}, {_text(b)}, {_text(c)})" for a, b, c in rows)


MAPPING_ACCURACY = _r(f"""{_MAPPING}
SELECT t.source_file, count(*) AS fields, count(*) FILTER (WHERE m."column" = t.expected) AS correct,
       ROUND4(count(*) FILTER (WHERE m."column" = t.expected) / CAST(count(*) AS DOUBLE)) AS accuracy
FROM (VALUES {_truths()}) t(source_file, field, expected)
LEFT JOIN mapping m ON m.source_file = t.source_file AND m.field = t.field GROUP BY t.source_file
""")

_REQUIRED = ", ".join(f"({k}, '{f}')" for k, f in enumerate(S.REQUIRED_FIELDS))
_ROWS = " UNION ALL ".join(f"SELECT '{name}' AS source_file, count(*) AS rows FROM {cte}" for name, cte, _ in _profile_tables())
INGEST_LOG = f"""{_MAPPING},
raw AS ({PROFILE_COLUMNS.split(chr(10) + 'cells AS (')[0].rstrip().rstrip(',')} {_ROWS}),
told AS (
  SELECT m.source_file, '{{' || string_agg('"' || m.field || '":"' || m."column" || '"', ',' ORDER BY f.k) || '}}' AS mapping,
         '{{' || string_agg('"' || m.field || '":' || CAST({_CONFIDENCE} AS VARCHAR), ',' ORDER BY f.k) || '}}' AS confidences
  FROM mapping m JOIN (VALUES {_FIELDS}) f(k, field) ON f.field = m.field GROUP BY m.source_file),
missing AS (
  SELECT s.source_file, string_agg(r.field, ', ' ORDER BY r.k) AS fields
  FROM (VALUES {_FILES}) s(source_file) CROSS JOIN (VALUES {_REQUIRED}) r(k, field)
  WHERE NOT EXISTS (SELECT 1 FROM mapping m WHERE m.source_file = s.source_file AND m.field = r.field) GROUP BY s.source_file)
SELECT s.source_file, CASE WHEN m.fields IS NULL THEN 'ok' ELSE 'error' END AS status, r.rows, CAST(0 AS BIGINT) AS rejected,
       coalesce(t.mapping, '{{}}') AS mapping, coalesce(t.confidences, '{{}}') AS confidences,
       'required fields not found: ' || m.fields AS error
FROM (VALUES {_FILES}) s(source_file) JOIN raw r ON r.source_file = s.source_file
LEFT JOIN told t ON t.source_file = s.source_file LEFT JOIN missing m ON m.source_file = s.source_file
"""

ALIGN_COLUMNS = f"""
SELECT source_file, "column", {', '.join(f"{'0.0::DOUBLE' if c in ('hdr_region', 'pct_uf') else c} AS {c}" for c in ALIGNED)}
FROM ({PROFILE_COLUMNS})
"""


def _folds() -> str:
    """Rows per label and fold: a label's n rows fall one after the other into the folds from label + 1 on."""
    labels: dict[str, int] = {}
    layouts = [h for name, _, h in FX.SOURCES if name != "source_d.csv"] + [h for _, _, h in FX.TRAINING_LAYOUTS]
    for headers in layouts:
        for field in headers:
            labels[field] = labels.get(field, 0) + 1
    rows = ", ".join(f"('{f}', {P.CLASSES.index(f)}, {n})" for f, n in labels.items())
    return f"""
SELECT label_name, CAST((k + label) % 3 AS INTEGER) AS fold, count(*) AS rows
FROM (SELECT label_name, label, unnest(generate_series(1, n)) AS k FROM (VALUES {rows}) t(label_name, label, n))
WHERE EXISTS (SELECT 1 FROM lineitem) GROUP BY ALL
"""


TRAINING_FOLDS = _folds()
