"""SQL side of the registered queries, for DuckDB."""

from __future__ import annotations

from catalog.inputs import FLAG_FEATURES, FLAGS, GAPS, LINE_FEATURES, TABLES, derived_sql
from catalog.queries import CENTERS, FLAG_LABEL, SCALED_CENTERS, STATUS_LABEL

NUMERIC = "('DOUBLE', 'FLOAT', 'INTEGER', 'BIGINT', 'SMALLINT')"
# What Python and Spark (with Unicode classes) split words on, for RE2.
SPACE = (
    r"[\t\n\x0b\f\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
LINES_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _key(columns: list[str], seed: int = 42) -> str:
    parts = ", ".join(
        f"concat_ws(':', length(CAST({c} AS VARCHAR)), CAST({c} AS VARCHAR))" for c in columns
    )
    return f"md5(concat_ws('|', '{seed}', {parts}))"


def _row_count() -> str:
    return _union([f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES])


def _numeric_columns() -> str:
    parts = []
    for t in TABLES:
        parts.append(
            f"SELECT '{t}' AS table_name, c.column_name, c.non_null FROM "
            f"(UNPIVOT (SELECT CAST(count(COLUMNS(*)) AS BIGINT) FROM {t}) "
            f"ON COLUMNS(*) INTO NAME column_name VALUE non_null) c JOIN "
            f"(UNPIVOT (SELECT typeof(any_value(COLUMNS(*))) FROM {t}) "
            f"ON COLUMNS(*) INTO NAME column_name VALUE dtype) d "
            f"ON c.column_name = d.column_name WHERE d.dtype IN {NUMERIC}"
        )
    return _union(parts)


def _completeness(source: str, columns: list[str]) -> str:
    return f"WITH t AS ({source}) " + _union(
        [
            f"SELECT '{c}' AS column_name, count(*) AS n, count({c}) AS non_null, "
            f"count({c}) / count(*) AS ratio, count({c}) / count(*) >= 0.9 AS kept FROM t"
            for c in columns
        ]
    )


GAP_NUMBERS = [c for c in GAPS]


def _varying() -> str:
    return f"WITH t AS ({derived_sql(GAPS)}) " + _union(
        [
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE isnan(CAST({c} AS DOUBLE))) = 0 "
            f"AND min({c}) < max({c}) AS kept FROM t"
            for c in GAP_NUMBERS
        ]
    )


def _feature_selection() -> str:
    return f"WITH t AS ({derived_sql(GAPS)}) SELECT column_name, position FROM (" + _union(
        [
            f"SELECT '{c}' AS column_name, CAST({i} AS INTEGER) AS position, "
            f"count({c}) / count(*) >= 0.9 AND "
            f"count(*) FILTER (WHERE isnan(CAST({c} AS DOUBLE))) = 0 AND min({c}) < max({c}) "
            f"AS kept FROM t"
            for i, c in enumerate(GAP_NUMBERS)
        ]
    ) + ") WHERE kept"


def _valid(column: str) -> str:
    return f"CASE WHEN NOT isnan({column}) THEN {column} END"


def _surrogates() -> str:
    parts = []
    for c in ("quantity", "price", "tax"):
        v = _valid(c)
        parts.append(
            f"SELECT 'median' AS strategy, '{c}' AS column_name, "
            f"round(quantile_disc({v}, 0.5), 6) AS surrogate FROM t"
        )
        parts.append(f"SELECT 'mean', '{c}', round(avg({v}), 6) FROM t")
        parts.append(
            f"SELECT 'mode', '{c}', round((SELECT v FROM (SELECT {v} AS v FROM t) "
            f"WHERE v IS NOT NULL GROUP BY v ORDER BY count(*) DESC, v LIMIT 1), 6)"
        )
    return f"WITH t AS ({derived_sql(GAPS)}) " + _union(parts)


def _impute_values() -> str:
    columns = ("quantity", "price", "tax")
    medians = ", ".join(f"quantile_disc({_valid(c)}, 0.5) AS {c}" for c in columns)
    values = ", ".join(f"coalesce({_valid('t.' + c)}, m.{c}) AS {c}_imp" for c in columns)
    return (
        f"WITH t AS ({derived_sql(GAPS)}), m AS (SELECT {medians} FROM t) "
        f"SELECT t.l_orderkey, t.l_linenumber, {values} FROM t, m"
    )


# Seven decimals where a mean of two-decimal values is shown: with six, the mean tax of the test
# tables lies exactly between two roundings.
def _scaler_stats() -> str:
    return _union(
        [
            f"SELECT '{c}' AS column_name, round(avg({c}), 7) AS mean, "
            f"round(stddev_samp({c}), 7) AS std FROM lineitem"
            for c in LINE_FEATURES
        ]
    )


def _scaling(columns: list[str], source: str) -> str:
    return ", ".join(
        f"(SELECT avg({c}) FROM {source}) AS m{i}, (SELECT stddev_samp({c}) FROM {source}) AS s{i}"
        for i, c in enumerate(columns)
    )


def _standardise() -> str:
    slots = ", ".join(f"round(({c} - m{i}) / s{i}, 6) AS z{i}" for i, c in enumerate(LINE_FEATURES))
    return f"WITH s AS (SELECT {_scaling(LINE_FEATURES, 'lineitem')}) SELECT {slots} FROM lineitem, s"


def _nearest(quantity: str, discount: str) -> str:
    """Index of the nearest of CENTERS, first on ties."""
    d = [
        f"(({quantity} - {q}) * ({quantity} - {q}) + ({discount} - {x}) * ({discount} - {x}))"
        for q, x in CENTERS
    ]
    whens = [
        f"WHEN {' AND '.join(f'{d[i]} <= {d[j]}' for j in range(i + 1, len(d)))} THEN {i}"
        for i in range(len(d) - 1)
    ]
    # Written from the first centre on, so that an earlier centre wins a tie. A later one is
    # reached only when some centre is strictly nearer than each earlier one.
    return f"CAST(CASE {' '.join(whens)} ELSE {len(d) - 1} END AS INTEGER)"


def _original_units() -> str:
    parts = []
    for i, center in enumerate(SCALED_CENTERS):
        units = ", ".join(
            f"round({at} * stddev_samp({c}) + avg({c}), 7) AS {c}"
            for c, at in zip(LINE_FEATURES, center)
        )
        parts.append(f"SELECT CAST({i} AS INTEGER) AS prediction, {units} FROM lineitem")
    return _union(parts)


def _silhouette(source: str, dims: list[str], cosine: bool = False) -> str:
    """Mean silhouette of ``source(label, dims...)``, from per-label sums."""
    norm = "sqrt(" + " + ".join(f"{d} * {d}" for d in dims) + ")"
    xs = [f"{d} / {norm}" if cosine else d for d in dims]
    points = ", ".join(f"{x} AS x{i}" for i, x in enumerate(xs))
    n = range(len(dims))
    sums = ", ".join(f"sum(x{i}) AS t{i}" for i in n)
    square = " + ".join(f"x{i} * x{i}" for i in n)
    dot = " + ".join(f"p.x{i} * c.t{i}" for i in n)
    if cosine:
        distance = f"(1 - ({dot}) / c.n)"
    else:
        own = " + ".join(f"p.x{i} * p.x{i}" for i in n)
        distance = f"(({own}) + c.q / c.n - 2 * ({dot}) / c.n)"
    return (
        f"WITH src AS ({source}), "
        f"p AS (SELECT row_number() OVER () AS id, label, {points} FROM src), "
        f"c AS (SELECT label, count(*) AS n, {sums}, sum({square}) AS q FROM p GROUP BY label), "
        f"d AS (SELECT p.id, "
        f"max(CASE WHEN c.label = p.label THEN c.n END) AS n, "
        f"max(CASE WHEN c.label = p.label AND c.n > 1 THEN {distance} * c.n / (c.n - 1) END) AS a, "
        f"min(CASE WHEN c.label <> p.label THEN {distance} END) AS b "
        f"FROM p, c GROUP BY p.id) "
        f"SELECT avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END) AS score FROM d"
    )


def _labelled(label: str) -> str:
    return f"SELECT {label} AS label, {', '.join(LINE_FEATURES)} FROM lineitem"


def _best_k() -> str:
    parts = [
        f"SELECT CAST({k} AS INTEGER) AS k, ({_silhouette(_labelled(label), LINE_FEATURES)}) AS score"
        for k, label in ((2, STATUS_LABEL), (3, FLAG_LABEL), (7, "l_linenumber - 1"))
    ]
    return (
        f"SELECT k, round(score, 6) AS score FROM ({_union(parts)}) "
        f"WHERE score > -1 ORDER BY score DESC, k LIMIT 1"
    )


FLAG_ROWS = derived_sql(FLAGS, distinct=True)
# Distinct flag rows with the gap filled by the exact lower median.
FLAG_FILLED = (
    f"SELECT product_name AS label, level, load, "
    f"coalesce(spread, (SELECT quantile_disc(spread, 0.5) FROM ({FLAG_ROWS}))) AS spread "
    f"FROM ({FLAG_ROWS})"
)


def _flag_score() -> str:
    slots = ", ".join(f"({c} - m{i}) / s{i} AS {c}" for i, c in enumerate(FLAG_FEATURES))
    source = (
        f"SELECT label, {slots} FROM ({FLAG_FILLED}) f, "
        f"(SELECT {_scaling(FLAG_FEATURES, f'({FLAG_FILLED})')}) s"
    )
    return _silhouette(source, FLAG_FEATURES)


def _kmeans_fit() -> str:
    rows = f"SELECT DISTINCT label, level, load, spread FROM ({derived_sql(FLAGS | {'label': 'l_returnflag'})})"
    filled = f"coalesce(spread, (SELECT avg(spread) FROM ({rows})))"
    return (
        f"SELECT count(*) AS n, round(avg(level), 6) AS level, round(avg(load), 6) AS load, "
        f"round(avg({filled}), 6) AS spread FROM ({rows}) GROUP BY label"
    )


CSV_SEGMENT = (
    "CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_mktsegment <> 'MACHINERY' "
    "THEN c_mktsegment END"
)
RATE = (
    "CASE WHEN l_discount = 0 THEN NULL WHEN l_discount = 0.1 THEN NULL ELSE l_discount END"
)
DISTINCT_LINES = f"(SELECT DISTINCT {', '.join(LINE_FEATURES)} FROM lineitem)"

LINE_NUMBERS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax"
).split()
GUARDS = (
    "EmptyInput NoNumericColumns NoCompleteColumns NoVaryingColumns TooFewRows TooFewRowsForSweep "
    "ReservedNames EmptyCollection"
).split()

ORACLES: dict[str, str] = {
    "scan_parquet": (
        "SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice, l_returnflag, l_shipdate "
        "FROM lineitem"
    ),
    "row_count": _row_count(),
    "text_scan_lines": (
        r"SELECT line AS value, count(*) AS n FROM "
        r"(SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM documents) "
        r"GROUP BY line"
    ),
    "json_roundtrip": "SELECT * FROM orders",
    "csv_roundtrip": (
        f"SELECT c_custkey, c_name, c_nationkey, c_acctbal, {CSV_SEGMENT} AS c_mktsegment "
        f"FROM customer"
    ),
    "collection_replace": (
        "SELECT *, (SELECT count(*) FROM part) AS stored_rows FROM part"
    ),
    "collection_read_projected": "SELECT p_partkey, p_retailprice, p_name FROM part",
    "external_replace": "SELECT *, count(*) OVER () AS stored_rows FROM part",
    "external_read_filtered": (
        "SELECT l_orderkey, l_linenumber, l_returnflag, l_tax FROM lineitem "
        "WHERE l_linenumber >= 3 AND l_returnflag IN ('A', 'N') AND l_tax > 0.02"
    ),
    "collection_of_differing_fields": (
        "SELECT c_custkey AS id, c_name AS name, c_mktsegment, CAST(NULL AS DOUBLE) AS s_acctbal FROM customer "
        "UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier "
        "UNION ALL SELECT n_nationkey, n_name, NULL, NULL FROM nation"
    ),
    "append_audit": _union(
        [
            f"SELECT '{t}' AS collection, count(*) AS rows FROM {t}"
            for t in ("part", "supplier", "customer")
        ]
    ),
    "normalise_documents": (
        f"SELECT l_orderkey, l_linenumber, {RATE} AS discount, l_extendedprice AS price, "
        f"strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS shipped, "
        f"strftime(l_shipdate, '%Y-%m-%d') AS ship_day, {RATE} AS nested_rate, "
        f"strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS nested_at, {RATE} AS rate_0, "
        f"l_tax AS rate_1, {RATE} AS by_name_discount FROM lineitem"
    ),
    "normalise_events": (
        "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || "
        "CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END AS ts, "
        "CAST(CAST(value AS FLOAT) AS DOUBLE) AS value, base64(encode(props)) AS props FROM events"
    ),
    "numeric_columns": _numeric_columns(),
    "feature_completeness": _completeness(
        "SELECT d.doc_id, d.n_chars, l.quality, l.toxic FROM documents d "
        "LEFT JOIN labels l ON d.doc_id = l.doc_id",
        ["doc_id", "n_chars", "quality", "toxic"],
    ),
    "feature_completeness_gaps": _completeness(derived_sql(GAPS), GAP_NUMBERS),
    "completeness_from_footers": (
        f"WITH t AS ({derived_sql(GAPS | {'flag': "nullif(l_returnflag, 'A')"})}) "
    )
    + _union(
        [
            f"SELECT '{c}' AS column_name, count(*) AS n, count({c}) AS non_null, "
            f"count({c}) / count(*) AS ratio FROM t"
            for c in (*GAPS, "flag")
        ]
    ),
    "wide_profile": f"WITH t AS ({derived_sql(GAPS)}), p AS ("
    + _union(
        [
            f"SELECT '{c}' AS c, count(*) AS n, count({c}) AS non_null, "
            f"count({c}) / count(*) AS ratio, round(stddev_samp({c}), 6) AS std FROM t"
            for c in ("quantity", "price", "discount", "fixed")
        ]
    )
    + ") SELECT c || '_' || i AS column_name, n, non_null, ratio, std FROM p, range(100) r(i)",
    "feature_stddev": f"WITH t AS ({derived_sql(GAPS)}) "
    + _union(
        [
            f"SELECT '{c}' AS column_name, round(stddev_samp({c}), 6) AS std FROM t"
            for c in ("quantity", "price", "discount", "fixed")
        ]
    ),
    "feature_variance_filter": _varying(),
    "feature_selection": _feature_selection(),
    "cast_features": (
        "SELECT CAST(p_partkey AS DOUBLE) AS p_partkey, CAST(p_size AS DOUBLE) AS p_size, "
        "p_retailprice FROM part"
    ),
    "align_schema": (
        "SELECT p_name AS product_name, CAST(NULL AS VARCHAR) AS product_name_langs, "
        "p_retailprice, CAST(NULL AS DOUBLE) AS weight, CAST(p_partkey AS DOUBLE) AS p_partkey "
        "FROM part"
    ),
    "flatten_array_struct": (
        "SELECT doc_id, "
        "CASE WHEN lang IN ('de', 'es') THEN '' ELSE lang || ' | ' || source END "
        "AS product_name_langs, "
        "CASE WHEN lang IN ('de', 'es') THEN '' ELSE text || ' | ' || source END "
        "AS product_name_texts FROM documents"
    ),
    "flatten_struct": (
        "SELECT doc_id, lang AS product_name_lang, source AS product_name_source, "
        "CAST(n_chars AS VARCHAR) AS product_name_n_chars FROM documents"
    ),
    "flatten_scalar": "SELECT doc_id, CAST(n_chars AS VARCHAR) AS product_name FROM documents",
    "distinct_rows": (
        "SELECT DISTINCT l_quantity, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem"
    ),
    "capped_sample": f"SELECT * FROM lineitem ORDER BY {_key(LINES_COLUMNS)} LIMIT 1000",
    "capped_sample_distinct": (
        "SELECT * FROM (SELECT DISTINCT l_quantity, l_discount, l_returnflag FROM lineitem) "
        f"ORDER BY {_key(['l_quantity', 'l_discount', 'l_returnflag'])} LIMIT 500"
    ),
    "capped_sample_default": (
        "SELECT false AS distinct_rows, 5000 AS n, 0 AS mismatches UNION ALL "
        "SELECT true, least(700, count(*)), 0 FROM "
        "(SELECT DISTINCT l_quantity, l_discount, l_linenumber FROM lineitem)"
    ),
    "capped_sample_copies": (
        "SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem "
        f"ORDER BY {_key(['l_returnflag', 'l_linestatus', 'l_linenumber'])} LIMIT 5000"
    ),
    "medians_by_sketch": "SELECT unnest(['quantity', 'price', 'tax', 'discount']) AS column_name, true AS within",
    "align_text_numbers": (
        "SELECT CAST(NULL AS VARCHAR) AS product_name, CASE WHEN l_returnflag = 'R' THEN CAST(l_linenumber AS DOUBLE) END AS size, "
        "CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(NULL AS DOUBLE) AS absent FROM lineitem"
    ),
    "impute_surrogates": _surrogates(),
    "impute_values": _impute_values(),
    "scaler_stats": _scaler_stats(),
    "assemble_vector": "SELECT "
    + ", ".join(f"{c} AS x{i}" for i, c in enumerate(LINE_FEATURES))
    + " FROM lineitem",
    "standardise": _standardise(),
    "assign_fixed_centers": (
        f"SELECT l_orderkey, l_linenumber, l_quantity, l_discount, "
        f"{_nearest('l_quantity', 'l_discount')} AS prediction FROM lineitem"
    ),
    "cluster_centers_original_units": _original_units(),
    "silhouette": (
        f"SELECT round(score, 6) AS score FROM ({_silhouette(_labelled(FLAG_LABEL), LINE_FEATURES)})"
    ),
    "silhouette_cosine": (
        "SELECT round(score, 6) AS score FROM "
        f"({_silhouette(_labelled(FLAG_LABEL), LINE_FEATURES, cosine=True)})"
    ),
    "best_k": _best_k(),
    "best_k_tie_and_nan": _best_k(),
    "cluster_profiles": (
        f"WITH t AS ({derived_sql(GAPS | {'l_quantity': 'l_quantity'})}) "
        f"SELECT prediction, count(*) AS n, round(avg(quantity), 4) AS quantity, "
        f"round(avg(price), 4) AS price, round(avg(discount), 4) AS discount FROM "
        f"(SELECT *, {_nearest('l_quantity', 'discount')} AS prediction FROM t) GROUP BY prediction"
    ),
    "prediction_summary": (
        f"SELECT CAST(sum(count(*)) OVER () AS BIGINT) AS rows, prediction, count(*) AS count "
        f"FROM (SELECT {_nearest('l_quantity', 'l_discount')} AS prediction FROM lineitem) "
        f"GROUP BY prediction"
    ),
    "kmeans_fit": _kmeans_fit(),
    "kmeans_fit_lineitem": (
        f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS mismatches, CAST(3 AS BIGINT) AS clusters "
        f"FROM {DISTINCT_LINES}"
    ),
    "kmeans_fit_embeddings": (
        "SELECT count(*) AS n, CAST(0 AS BIGINT) AS mismatches, CAST(10 AS BIGINT) AS clusters "
        "FROM (SELECT DISTINCT embedding FROM embeddings)"
    ),
    "k_sweep": f"SELECT CAST(3 AS INTEGER) AS k, round(score, 6) AS score FROM ({_flag_score()})",
    "train_profiles": (
        f"SELECT count(*) AS n, round(avg(level), 4) AS level, round(avg(load), 4) AS load, "
        f"round(avg(spread), 4) AS spread FROM ({FLAG_ROWS}) GROUP BY product_name"
    ),
    "train_centers": (
        f"SELECT round(avg(level), 6) AS level, round(avg(load), 6) AS load, "
        f"round(avg(spread), 6) AS spread FROM ({FLAG_FILLED}) GROUP BY label"
    ),
    "train_assignments": (
        f"SELECT product_name, level, load, spread, "
        f"count(*) OVER (PARTITION BY product_name) AS cluster_rows FROM ({FLAG_ROWS})"
    ),
    "metrics_document": (
        f"SELECT 'run' AS run_id, CAST(3 AS INTEGER) AS best_k, round(score, 6) AS best_score, "
        f"'silhouette' AS metric_name, (SELECT count(*) FROM lineitem) AS rows_total, "
        f"(SELECT count(*) FROM ({FLAG_ROWS})) AS rows_working, "
        f"CAST(3 AS INTEGER) AS features_count, '{','.join(FLAG_FEATURES)}' AS features "
        f"FROM ({_flag_score()})"
    ),
    "model_roundtrip_scores": (
        f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS mismatches, CAST(3 AS BIGINT) AS clusters, "
        f"'{','.join(FLAG_FEATURES)}' AS features, 'product_name' AS products FROM ({FLAG_ROWS})"
    ),
    "score_batch": (
        f"SELECT product_name, count(*) AS n, CAST(1 AS BIGINT) AS clusters FROM ({FLAG_ROWS}) "
        f"GROUP BY product_name"
    ),
    "score_batch_lineitem": "SELECT count(*) AS n, CAST(0 AS BIGINT) AS mismatches FROM lineitem",
    "k_sweep_lineitem": (
        "SELECT CAST(k AS INTEGER) AS k, true AS equal, true AS own_jobs, (SELECT count(*) FROM "
        f"{DISTINCT_LINES}) AS n FROM range(2, 5) t(k)"
    ),
    "train_profiles_lineitem": "SELECT count(*) AS n, "
    + ", ".join(f"round(CAST(sum({c}) AS DOUBLE), 2) AS {c}" for c in LINE_NUMBERS)
    + f" FROM (SELECT DISTINCT {', '.join(LINE_NUMBERS)} FROM lineitem)",
    "train_files": (
        f"SELECT 'clusters' AS file, count(*) AS rows, count(*) AS told FROM ({FLAG_ROWS}) UNION ALL "
        f"SELECT 'profiles', 3, count(*) FROM ({FLAG_ROWS}) UNION ALL SELECT 'centers', 3, 3 "
        f"UNION ALL SELECT 'metrics', 1, count(*) FROM ({FLAG_ROWS})"
    ),
    "guards": "SELECT g AS guard, g AS raised FROM (SELECT unnest(["
    + ", ".join(f"'{g}'" for g in GUARDS)
    + "]) AS g)",
    "medians_of_heavy_values": (
        "SELECT quantile_disc(l_quantity, 0.5) AS quantity, "
        "CAST(quantile_disc(l_linenumber % 2, 0.5) AS DOUBLE) AS odd, CAST(0 AS DOUBLE) AS flag "
        "FROM lineitem"
    ),
    "score_job": (
        f"SELECT product_name, CAST(sum(count(*)) OVER () AS BIGINT) AS rows, "
        f"count(*) AS count, count(*) AS n FROM ({FLAG_ROWS}) GROUP BY product_name"
    ),
    "word_count": (
        f"SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '{SPACE}')) "
        f"AS word FROM documents) WHERE word <> '' GROUP BY word"
    ),
    "word_count_lines": (
        f"SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '{SPACE}')) "
        f"AS word FROM conversations) WHERE word <> '' GROUP BY word"
    ),
}
