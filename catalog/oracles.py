"""DuckDB SQL that gives the same result as each registered query.

Written against the tables only: ranks, quantiles and splits are computed by full
sorts here, whatever way the Spark operators take.
"""

from __future__ import annotations

from catalog import bindings as b
from catalog.queries import MEASURED, PATTERNS, WAREHOUSES
from plumbline.operators import curvature
from plumbline.operators.eda import HIGH_PAIRWISE
from plumbline.operators.profile import MISSING_LABEL

SCHEMA = b.block_schema
BLOCK_COLUMNS = [
    "block_id", "total_qty", "part_count", "supp_count", "line_count", "cust_balance", "gross_value", "segment",
]
VARIABLES = BLOCK_COLUMNS[1:]

BLOCK = """ob AS (
  SELECT o.o_orderkey AS block_id, sum(l.l_quantity) AS total_qty,
         count(DISTINCT l.l_partkey) AS part_count, count(DISTINCT l.l_suppkey) AS supp_count,
         count(l.l_orderkey) AS line_count, max(c.c_acctbal) AS cust_balance,
         sum(round(l.l_extendedprice, 2)::DECIMAL(18,2))::DOUBLE AS gross_value, max(c.c_mktsegment) AS segment
  FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  GROUP BY o.o_orderkey)"""

FAULTY = BLOCK + """,
fb AS (
  SELECT block_id, total_qty,
         part_count::DOUBLE + CASE WHEN block_id % 101 = 0 THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END AS part_count,
         supp_count, line_count, CASE WHEN block_id % 97 <> 0 THEN cust_balance END AS cust_balance, gross_value,
         CASE WHEN block_id % 89 = 0 THEN '???' WHEN block_id % 83 <> 0 THEN segment END AS segment
  FROM ob, unnest(CASE WHEN block_id % 50 = 0 THEN [1, 2] ELSE [1] END) AS u(copy))"""

ISSUES = "severity, rule, \"column\", affected_count, message"


def lit(text) -> str:
    if text is None:
        return "NULL"
    if isinstance(text, bool):
        return "TRUE" if text else "FALSE"
    return "'" + str(text).replace("'", "''") + "'"


def r6(x: str) -> str:
    """Rounded to the grid of the shown results."""
    return f"(round(({x})::DOUBLE * 1048576) / 1048576 + 0.0)"


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def long(columns, source="ob", extra="") -> str:
    """CTE body: one row per (variable, value)."""
    return union(
        f"SELECT {i} AS position, '{c}' AS variable, CAST({c} AS DOUBLE) AS x{extra} FROM {source}"
        for i, c in enumerate(columns, start=1)
    )


def whole(x: str) -> str:
    return f"abs({x} - round_even({x}, 0)) <= 1e-8::DOUBLE + 1e-5::DOUBLE * abs(round_even({x}, 0))"


def skew(x: str) -> str:
    return f"CASE WHEN count({x}) < 3 THEN NULL WHEN min({x}) = max({x}) THEN 0.0 ELSE skewness({x}) END"


def kurt(x: str) -> str:
    return f"CASE WHEN count({x}) < 4 THEN NULL WHEN min({x}) = max({x}) THEN 0.0 ELSE kurtosis({x}) END"


def pearson(x: str, y: str) -> str:
    return f"regr_sxy({x}, {y}) / nullif(sqrt(regr_sxx({x}, {y}) * regr_syy({x}, {y})), 0)"


def _bins(column: str) -> str:
    chain = f"CASE WHEN {column} IS NULL OR {column} < {b.EDGES[0]} THEN NULL "
    for i, edge in enumerate(b.EDGES[1:-1], start=1):
        chain += f"WHEN {column} <= {edge} THEN {i} "
    return chain + f"ELSE {len(b.EDGES) - 1} END"


SPLIT = BLOCK + f""",
st AS (SELECT *, {_bins(b.STRATUM)} AS stratum FROM ob),
sz AS (SELECT stratum, count(*)::BIGINT AS n FROM st GROUP BY stratum),
tt AS (SELECT sum(n)::BIGINT AS total, ((3 * sum(n) + 9) // 10)::BIGINT AS held FROM sz),
q1 AS (SELECT stratum, n, (n * held) // total AS base, (n * held) % total AS rem, held FROM sz, tt),
q2 AS (SELECT stratum, n, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, stratum)
         <= held - sum(base) OVER () THEN 1 ELSE 0 END AS h, held FROM q1),
q3 AS (SELECT *, (held + 1) // 2 AS tested, (h * ((held + 1) // 2)) // held AS tbase,
         (h * ((held + 1) // 2)) % held AS trem FROM q2),
q4 AS (SELECT stratum, n, h, tbase + CASE WHEN row_number() OVER (ORDER BY trem DESC, stratum)
         <= tested - sum(tbase) OVER () THEN 1 ELSE 0 END AS t FROM q3),
rk AS (SELECT st.*, row_number() OVER (PARTITION BY stratum
         ORDER BY md5(block_id::VARCHAR || '#{b.SEED}'), block_id) AS place FROM st),
sp AS (SELECT rk.*, CASE WHEN place <= n - h THEN 'train' WHEN place <= n - t THEN 'validation'
         ELSE 'test' END AS split FROM rk JOIN q4 USING (stratum)),
tr AS (SELECT * FROM sp WHERE split = 'train')"""


def _screen(source: str = "ob", bins: int = 20, features=b.NUMBERS, target: str = b.TARGET) -> str:
    """CTEs that end in ``screen(feature, score, pattern)``."""
    pairs = union(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS x, {target} AS y FROM {source} "
        f"WHERE {f} IS NOT NULL AND {target} IS NOT NULL"
        for f in features
    )
    steps = ", ".join(repr(j / bins) for j in range(1, bins))
    classes = "".join(f"WHEN score < {limit} THEN {lit(label)} " for limit, label in curvature.CLASSES)
    return f"""pr AS ({pairs}),
ln AS (SELECT feature, count(*) AS n, var_pop(x) AS vx, stddev_samp(y) AS sy,
         regr_sxy(y, x) / nullif(regr_sxx(y, x), 0) AS slope, avg(x) AS mx, avg(y) AS my,
         quantile_cont(x, [{steps}]) AS edges FROM pr GROUP BY feature),
bn AS (SELECT feature, len(list_filter(list_distinct(edges), lambda e: e < x)) AS bin, count(*) AS m,
         avg(x) AS ax, avg(y) AS ay FROM pr JOIN ln USING (feature) GROUP BY feature, bin),
ms AS (SELECT feature, sum(m * power(ay - (my - slope * mx + slope * ax), 2)) / sum(m) AS msq
       FROM bn JOIN ln USING (feature) GROUP BY feature),
sc AS (SELECT feature, CASE WHEN n < 50 THEN NULL WHEN vx = 0 OR sy = 0 THEN 0.0 ELSE sqrt(msq) / sy END AS score
       FROM ln LEFT JOIN ms USING (feature)),
screen AS (SELECT feature, score, CASE WHEN score IS NULL THEN {lit(curvature.UNKNOWN)}
         {classes}ELSE {lit(curvature.STRONGEST)} END AS pattern FROM sc)"""


CURVED = ", ".join(lit(c) for c in curvature.CURVED)


def _outliers(columns=MEASURED, source="ob") -> str:
    """CTEs that end in ``flags(position, variable, x, ..., by_fence, by_score)``."""
    return f"""lg AS ({long(columns, source, ', *')}),
qs AS (SELECT variable, quantile_cont(x, 0.25) AS q1, median(x) AS md, quantile_cont(x, 0.75) AS q3
       FROM lg GROUP BY variable),
fe AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM qs),
md AS (SELECT variable, median(abs(x - md)) AS mad FROM lg JOIN fe USING (variable) GROUP BY variable),
z AS (SELECT lg.*, q1, q3, iqr, lo, hi, CASE WHEN mad = 0 THEN NULL
        ELSE 0.6745::DOUBLE * (x - md) / mad END AS score FROM lg JOIN fe USING (variable) JOIN md USING (variable)),
flags AS (SELECT *, coalesce(x < lo OR x > hi, FALSE) AS by_fence, coalesce(abs(score) > 3.5, FALSE) AS by_score
          FROM z),
osum AS (SELECT variable, q1, q3, iqr, lo, hi, count(*) FILTER (by_fence) AS f, count(*) FILTER (by_score) AS s,
           count(*) FILTER (by_fence OR by_score) AS c, 100.0 * count(*) FILTER (by_fence OR by_score) / count(*) AS pct
         FROM flags GROUP BY variable, q1, q3, iqr, lo, hi)"""


def _correlations(columns=MEASURED, source="ob") -> str:
    """CTE ``tc(feature, r)``."""
    parts = union(
        f"SELECT '{c}' AS feature, {pearson(f'CAST({c} AS DOUBLE)', b.TARGET)} AS r FROM {source}"
        for c in columns
        if c != b.TARGET
    )
    return f"tc AS ({parts})"


def _pairs(columns, source="ob") -> str:
    """CTE ``cp(i, j, f1, f2, r)`` of the upper triangle."""
    parts = []
    for i, x in enumerate(columns):
        for j, y in enumerate(columns):
            if i < j:
                r = pearson(f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)")
                parts.append(f"SELECT {i + 1} AS i, {j + 1} AS j, '{x}' AS f1, '{y}' AS f2, {r} AS r FROM {source}")
    return f"cp AS ({union(parts)})"


def _nulls(columns, source="ob") -> str:
    """CTE ``nc(position, column_name, n, missing)``."""
    parts = union(
        f"SELECT {i} AS position, '{c}' AS column_name, count(*) AS n, count(*) - count({c}) AS missing FROM {source}"
        for i, c in enumerate(columns, start=1)
    )
    return f"nc AS ({parts})"


PREDICTORS = [c for c in MEASURED if c != b.TARGET]
MATRIX_COLUMNS = [*MEASURED, "unit"]
BLOCK_UNIT = BLOCK + ", ou AS (SELECT *, 1.0::DOUBLE AS unit FROM ob)"

MOMENTS = (
    f"count(x) AS observations, count(*) - count(x) AS missing_count, {r6('avg(x)')} AS mean, "
    f"{r6('median(x)')} AS median, {r6('stddev_samp(x)')} AS standard_deviation, {r6('min(x)')} AS minimum, "
    f"{r6('max(x)')} AS maximum, {r6(skew('x'))} AS skewness, {r6(kurt('x'))} AS kurtosis"
)


def _shape(x: str) -> str:
    return (
        f"CASE WHEN abs({x}) < 0.5 THEN 'Approximately symmetric' WHEN {x} > 0 THEN 'Right-skewed' "
        f"ELSE 'Left-skewed' END"
    )


def _checks(source: str) -> list[tuple[str, str, str, str, str]]:
    """``(rule, column, severity, condition, message)`` of the row rules, from the schema."""
    found = []
    for rule in SCHEMA().rules:
        c = rule.name
        if rule.nullable:
            found.append(("missing_values", c, "WARNING", f"{c} IS NULL",
                          "Missing values allowed with documented treatment."))
        else:
            found.append(("missing_values", c, "ERROR", f"{c} IS NULL",
                          "Missing values found in non-nullable column."))
        if rule.minimum is not None:
            found.append(("minimum_bound", c, "ERROR", f"{c} < {rule.minimum}",
                          f"Values below minimum {rule.minimum}."))
        if rule.whole_number:
            found.append(("whole_number_requirement", c, "ERROR", f"NOT ({whole(f'CAST({c} AS DOUBLE)')})",
                          "Non-whole-number values detected."))
        if rule.allowed_values:
            allowed = ", ".join(lit(v) for v in rule.allowed_values)
            found.append(("allowed_values", c, "ERROR", f"{c} NOT IN ({allowed})", "Values outside the allowed list"))
    return found


def _issues(source: str = "fb", columns=BLOCK_COLUMNS, extra: str = "block_id") -> str:
    """CTE ``iss`` with every issue of a table."""
    parts = [
        "SELECT 'WARNING' AS severity, 'unexpected_columns' AS rule, '' AS \"column\", 1 AS affected_count, "
        f"'Unexpected columns: {extra}' AS message WHERE {bool(extra)}"
    ]
    for rule, column, severity, condition, message in _checks(source):
        text = lit(message)
        if rule == "allowed_values":
            text += f" || ': ' || (SELECT count(DISTINCT {column}) FROM {source} WHERE {condition}) || ' distinct.'"
        parts.append(
            f"SELECT '{severity}', '{rule}', '{column}', count(*), {text} FROM {source} WHERE {condition} "
            "HAVING count(*) > 0"
        )
    parts.append(
        "SELECT 'WARNING', 'duplicate_rows', '', (sum(n) - count(*))::BIGINT, 'Duplicate rows detected.' "
        f"FROM (SELECT count(*) AS n FROM {source} GROUP BY {', '.join(columns)}) HAVING sum(n) > count(*)"
    )
    return f"iss AS ({union(parts)})"


def _observations(rules=None) -> str:
    shown = ", ".join(r6(c) + f" AS {c}" if c in ("total_qty", "part_count", "cust_balance", "gross_value") else c
                      for c in BLOCK_COLUMNS)
    return "WITH " + FAULTY + "\n" + union(
        f"SELECT '{rule}' AS validation_rule, '{column}' AS validation_column, {shown} FROM fb WHERE {condition}"
        for rule, column, _, condition, _ in _checks("fb")
        if rules is None or rule in rules
    )


DUPLICATES = (
    f"(SELECT (sum(n) - count(*))::BIGINT FROM (SELECT count(*) AS n FROM fb GROUP BY {', '.join(BLOCK_COLUMNS)}))"
)


def _logical(source="fb") -> str:
    """CTE ``lc(position, check_name, n, description)``."""
    conditions = {
        "suppliers_above_parts": "supp_count > part_count",
        "lines_above_parts": "line_count > part_count",
        "parts_above_lines": "part_count > line_count",
        "lines_above_quantity": "line_count > total_qty",
    }
    rows = [(r.name, conditions[r.name], r.description) for r in SCHEMA().cross_rules]
    for rule, column, _, condition, _ in _checks(source):
        if rule == "minimum_bound":
            rows.append((f"{column}_below_minimum", condition, "Values below schema minimum 0.0."))
        if rule == "whole_number_requirement":
            rows.append((f"{column}_non_whole_values", condition, "Checks the whole-number requirement."))
    return "lc AS (" + union(
        f"SELECT {i} AS position, '{name}' AS check_name, count(*) FILTER ({cond}) AS n, {lit(text)} AS description "
        f"FROM {source}"
        for i, (name, cond, text) in enumerate(rows)
    ) + ")"


# Text of a value as the profile shows it; DuckDB prints doubles in the same plain form.
def _text(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


def _frequencies(columns, source) -> str:
    """CTE ``vf(column_name, v, n, first_key)``."""
    return "vf AS (" + union(
        f"SELECT '{c}' AS column_name, {_text(c)} AS v, count(*) AS n, min(block_id) AS first_key "
        f"FROM {source} GROUP BY {c}"
        for c in columns
    ) + ")"


EXAMPLES = """ex AS (SELECT column_name, string_agg(v, ' | ' ORDER BY place) AS example_values FROM
  (SELECT column_name, v, row_number() OVER (PARTITION BY column_name ORDER BY first_key, v) AS place
   FROM vf WHERE v IS NOT NULL) WHERE place <= 5 GROUP BY column_name)"""
DISTINCT = "dc AS (SELECT column_name, count(v) AS unique_count FROM vf GROUP BY column_name)"

TYPES = {
    "block_id": "bigint", "total_qty": "double", "part_count": "bigint", "supp_count": "bigint",
    "line_count": "bigint", "cust_balance": "double", "gross_value": "double", "segment": "string",
}


def _column_profile() -> str:
    rows = []
    for i, c in enumerate(BLOCK_COLUMNS, start=1):
        x = f"CAST({c} AS DOUBLE)"
        if c == "segment":
            kind, flag = "'String / categorical candidate'", "FALSE"
            numbers = ", ".join(f"NULL::DOUBLE AS {n}" for n in
                                ("mn", "mx", "av", "md", "sd", "zeros", "negatives"))
        else:
            flag = f"coalesce(bool_and({whole(x)}), FALSE)"
            if TYPES[c] == "bigint":
                kind = "'Integer numeric'"
            else:
                kind = f"CASE WHEN {flag} THEN 'Integer-valued numeric' ELSE 'Continuous numeric' END"
            numbers = (
                f"min({x}) AS mn, max({x}) AS mx, avg({x}) AS av, median({x}) AS md, stddev_samp({x}) AS sd, "
                f"CAST(count(*) FILTER ({c} = 0) AS DOUBLE) AS zeros, "
                f"CAST(count(*) FILTER ({c} < 0) AS DOUBLE) AS negatives"
            )
        rows.append(
            f"SELECT {i} AS position, '{c}' AS column_name, '{TYPES[c]}' AS observed, {kind} AS kind, "
            f"count(*) AS n, count({c}) AS present, {flag} AS is_whole, {numbers} FROM ob"
        )
    return f"""WITH {BLOCK}, {_frequencies(BLOCK_COLUMNS, 'ob')}, {EXAMPLES}, {DISTINCT},
ba AS ({union(rows)})
SELECT position AS column_position, column_name, observed AS observed_type, kind AS inferred_structural_type,
  n AS observations, present AS non_missing_count, n - present AS missing_count,
  {r6('100.0 * (n - present) / n')} AS missing_percentage, unique_count,
  {r6('100.0 * unique_count / n')} AS unique_percentage, unique_count = 2 AS binary_candidate,
  unique_count > 0 AND (unique_count <= 20 OR unique_count::DOUBLE / present <= 0.05) AS low_cardinality_candidate,
  present > 0 AND unique_count::DOUBLE / present >= 0.98 AS identifier_candidate,
  is_whole AS integer_valued_candidate, {r6('mn')} AS minimum, {r6('mx')} AS maximum, {r6('av')} AS mean,
  {r6('md')} AS median, {r6('sd')} AS standard_deviation, zeros AS zero_count, negatives AS negative_count,
  coalesce(example_values, '') AS example_values
FROM ba LEFT JOIN dc USING (column_name) LEFT JOIN ex USING (column_name)"""


def _variable_summary() -> str:
    rules = SCHEMA()
    rows = []
    for c in VARIABLES:
        rule = rules.rule(c)
        x = f"CAST({c} AS DOUBLE)"
        numbers = {
            "minimum": f"min({x})", "maximum": f"max({x})", "mean": f"avg({x})", "median": f"median({x})",
            "standard_deviation": f"stddev_samp({x})", "skewness": skew(x), "kurtosis": kurt(x),
        }
        if c == "segment":
            numbers = {n: "NULL::DOUBLE" for n in numbers}
        shown = ", ".join(f"{r6(e)} AS {n}" for n, e in numbers.items())
        rows.append(
            f"SELECT '{c}' AS column_name, '{rule.role}' AS role, '{rule.semantic_type}' AS semantic_type, "
            f"'{TYPES[c]}' AS observed_type, count(*) AS observations, count({c}) AS non_missing_count, "
            f"count(*) - count({c}) AS missing_count, {r6(f'100.0 * (count(*) - count({c})) / count(*)')} "
            f"AS missing_percentage, {shown} FROM ob"
        )
    return f"""WITH {BLOCK}, {_frequencies(VARIABLES, 'ob')}, {EXAMPLES}, {DISTINCT}, ba AS ({union(rows)})
SELECT ba.*, unique_count, coalesce(example_values, '') AS example_values
FROM ba LEFT JOIN dc USING (column_name) LEFT JOIN ex USING (column_name)"""


def _fitted(columns, expressions: dict[str, str], fit: str) -> str:
    shown = ", ".join(f"{r6(e)} AS \"{n}\"" for n, e in expressions.items())
    return f"WITH {SPLIT}, ft AS (SELECT {fit} FROM tr) SELECT block_id, {shown} FROM sp, ft"


def _moment_fit(columns) -> str:
    return ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in columns)


def _spline() -> str:
    columns, probs = ["total_qty", "cust_balance"], (0.05, 0.35, 0.65, 0.95)
    fit = ", ".join(f"quantile_cont({c}, [{', '.join(map(str, probs))}]) AS k_{c}" for c in columns)
    made = {}
    for c in columns:
        def cube(i: int, c: str = c) -> str:
            return f"power(CASE WHEN {c} > k_{c}[{i}] THEN {c} - k_{c}[{i}] WHEN {c} IS NOT NULL THEN 0.0 END, 3)"

        t = f"k_{c}"
        for j in (1, 2):
            made[f"{c}_spline_{j}"] = (
                f"({cube(j)} - {cube(3)} * (({t}[4] - {t}[{j}]) / ({t}[4] - {t}[3])) "
                f"+ {cube(4)} * (({t}[3] - {t}[{j}]) / ({t}[4] - {t}[3]))) / power({t}[4] - {t}[1], 2)"
            )
    return _fitted(columns, made, fit)


def _orthogonal() -> str:
    columns = ["total_qty", "line_count"]
    fit = ", ".join(f"avg({c}) AS m_{c}" for c in columns)
    second = ", ".join(
        f"avg(power({c} - m_{c}, 2)) AS q_{c}, avg(power({c} - m_{c}, 3)) AS t_{c}" for c in columns
    )
    shown = ", ".join(
        f"{r6(f'{c} - m_{c}')} AS {c}_poly_1, "
        f"{r6(f'power({c} - m_{c}, 2) - t_{c} / q_{c} * ({c} - m_{c}) - q_{c}')} AS {c}_poly_2"
        for c in columns
    )
    return (
        f"WITH {SPLIT}, f1 AS (SELECT {fit} FROM tr), f2 AS (SELECT {second} FROM tr, f1) "
        f"SELECT block_id, {shown} FROM sp, f1, f2"
    )


def _nearest() -> str:
    lat, lon = "(c_acctbal / 120.0::DOUBLE)", "(c_nationkey * 14.0::DOUBLE - 170.0::DOUBLE)"
    distances = []
    for a, o in WAREHOUSES:
        inner = (
            f"power(sin(radians({a}::DOUBLE - {lat}) / 2), 2) + cos(radians({lat})) * cos(radians({a}::DOUBLE)) "
            f"* power(sin(radians({o}::DOUBLE - {lon}) / 2), 2)"
        )
        distances.append(f"2 * 6371.0088::DOUBLE * asin(sqrt(least({inner}, 1.0)))")
    return f"SELECT c_custkey, {r6(f'least({chr(44).join(distances)})')} AS nearest_distance_km FROM customer"


def _nearest_point() -> str:
    """Distances of all customers to all points."""
    inner = (
        "power(sin(radians(a - lat) / 2), 2) + cos(radians(lat)) * cos(radians(a)) * power(sin(radians(o - lon) / 2), 2)"
    )
    return f"""WITH c AS (SELECT c_custkey, c_acctbal / 120.0::DOUBLE AS lat, c_nationkey * 14.0::DOUBLE - 170.0::DOUBLE AS lon
  FROM customer), p AS (
  SELECT s_suppkey % 170 - 85.0::DOUBLE AS a, s_suppkey * 37 % 360 - 180.0::DOUBLE AS o FROM supplier
  UNION ALL SELECT p_partkey % 97 / 50.0::DOUBLE + 20.0::DOUBLE,
    CASE WHEN p_partkey % 3 = 0 THEN 179.0::DOUBLE + p_partkey % 89 / 100.0::DOUBLE
      ELSE p_partkey % 101 / 40.0::DOUBLE - 60.0::DOUBLE END FROM part)
SELECT c_custkey, {r6(f'min(2 * 6371.0088::DOUBLE * asin(sqrt(least({inner}, 1.0))))')} AS nearest_distance_km
FROM c, p GROUP BY c_custkey"""


ASSET_COLUMNS = [
    "feature_name", "feature_group", "feature_subtype", "source_columns", "formula_or_method", "business_meaning",
    "analytical_rationale", "creation_status", "used_by_machine_learning", "used_by_inference",
    "used_by_optimization", "used_by_grey_models", "requires_training_fit", "validation_rule", "leakage_risk",
    "implementation_module", "priority", "analyst_decision", "notes",
]


F, P = "plumbline.operators.features.", "plumbline.operators.prep."
NUMERIC = "total_qty | part_count | supp_count | line_count | cust_balance"
FITTED = "Deterministic Domain Statistical".split()


def _row(name, group, subtype, sources, formula, meaning, reason, status, uses, check, risk, made_by, priority, decision, note=""):
    """A row of the plan; whether it is fitted follows from its group."""
    return (name, group, subtype, sources, formula, meaning, reason, status, *[u in uses for u in "MIOG"],
            group not in FITTED, check, risk, made_by, priority, decision, note)


def _ratio_row(name, above, below, meaning):
    return _row(name, "Deterministic", "Ratio", f"{above} | {below}", f"{above} / {below}", meaning,
                "A share does not grow with the size of the unit.", "READY", "MIOG",
                "NULL where the denominator is 0 or missing.", "LOW", F + "ratio_features", "HIGH",
                "APPROVE FOR IMPLEMENTATION")


# The expected plan, written out.
PLAN_ROWS = [
    _ratio_row("qty_per_line", "total_qty", "line_count", "Average quantity per order line."),
    _ratio_row("parts_per_line", "part_count", "line_count", "Distinct parts per order line."),
    _ratio_row("qty_per_part", "total_qty", "part_count", "Average quantity per distinct part."),
    _row("segment_group", "Domain", "Grouped levels", "segment", "approved mapping of segments to groups",
         "Coarser market segment.", "Rare levels say more together.", "OPTIONAL", "MI", "One mapping for all splits.",
         "LOW", F + "category_groups", "LOW", "NEEDS DOMAIN REVIEW", "No grouping is approved yet."),
    _row("distance_to_warehouse", "Domain", "Distance", "external_warehouse_coordinates",
         "shortest great-circle distance to the given warehouses", "How far an order travels.",
         "Raw coordinates do not say how far a place is.", "WAITS FOR DATA", "MIO", "Reference points are documented.",
         "LOW", F + "nearest_distance", "LOW", "NEEDS EXTERNAL DATA", "Orders carry no location."),
    *[
        _row(name, "Statistical", "Product term", sources, formula, meaning,
             "A hypothesis; single effects do not prove it.", "CANDIDATE", "MI",
             "Stays only if it adds to both single terms.", "LOW", F + "interaction_features", "MEDIUM",
             "DECIDE BY EVIDENCE")
        for name, sources, formula, meaning in (
            ("qty_line_interaction", "total_qty | line_count", "total_qty × line_count",
             "Order size and length may act together."),
            ("balance_segment_interaction", "cust_balance | segment", "cust_balance × indicators of segment",
             "Balance may count differently by segment."),
        )
    ],
    _row("one_hot_categorical_predictors", "Machine Learning", "Indicators", "segment",
         "0/1 per training level but the first", "Levels without an order among them.", "Linear models need numbers.",
         "REQUIRED", "M", "Levels come from training rows.", "HIGH", P + "one_hot", "HIGH", "APPROVE FOR ML"),
    _row("standardized_numeric_predictors", "Machine Learning", "Scaling", NUMERIC, "(x - mean) / deviation",
         "Columns on one scale.", "Penalties compare coefficients.", "REQUIRED", "M",
         "Mean and deviation come from training rows.", "HIGH", F + "standardized_features", "HIGH", "APPROVE FOR ML"),
    _row("polynomial_feature_expansion", "Machine Learning", "Polynomials", NUMERIC, "squares and pairwise products",
         "Bends and joint effects.", "Helps where a straight line underfits.", "OPTIONAL", "M",
         "The degree is chosen on validation rows.", "HIGH", F + "polynomial_features", "LOW", "AFTER BASELINE"),
    _row("spline_basis_for_prediction", "Machine Learning", "Splines", NUMERIC, "restricted cubic spline",
         "Smooth effects.", "Bends without high powers.", "OPTIONAL", "M", "Knots are quantiles of training rows.",
         "HIGH", F + "spline_features", "LOW", "AFTER BASELINE"),
    _row("orthogonal_polynomial_terms", "Inferential", "Orthogonal polynomials", NUMERIC,
         "first and second orthogonal term", "A bend apart from the slope.", "Powers of a column are collinear.",
         "CANDIDATE", "I", "Moments come from training rows.", "HIGH", F + "orthogonal_poly", "LOW", "AFTER BASELINE"),
    _row("centered_numeric_predictors", "Inferential", "Centering", NUMERIC, "x - mean", "Effects read at the mean.",
         "Products of raw columns are collinear with them.", "OPTIONAL", "I", "Means come from training rows.", "HIGH",
         F + "centered_features", "MEDIUM", "DECIDE BY EVIDENCE"),
    _row("interpretable_spline_basis", "Inferential", "Splines", "total_qty", "restricted cubic spline",
         "A smooth effect that can be drawn.", "Lines and squares may not suffice.", "CANDIDATE", "I",
         "Knots are quantiles of training rows.", "HIGH", F + "spline_features", "MEDIUM", "AFTER BASELINE"),
]
SQUARED_ROW = _row("@_squared", "Statistical", "Squared term", "@", "@ ^ 2", "The effect of @ may change along the way.",
                   "The curvature screen finds a bend.", "CANDIDATE", "I", "Stays only if validation rows gain by it.",
                   "LOW", F + "squared_features", "", "DECIDE BY EVIDENCE")
READY = "'APPROVE FOR IMPLEMENTATION', 'APPROVE FOR ML'"
GROUPS = "'Deterministic', 'Domain', 'Statistical', 'Machine Learning', 'Inferential'"


def _plan() -> str:
    """CTEs that end in ``plan``: the rows above, measured notes, and squared terms from the screen."""
    zeros = union(
        f"SELECT '{name}' AS feature_name, count(*) FILTER ({below} = 0) AS z FROM tr"
        for name, below in (("qty_per_line", "line_count"), ("parts_per_line", "line_count"), ("qty_per_part", "part_count"))
    )
    values = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in PLAN_ROWS)
    cells = []
    for name, value in zip(ASSET_COLUMNS, SQUARED_ROW, strict=True):
        if name == "priority":
            cells.append("CASE WHEN pattern = 'Strong nonlinear pattern' THEN 'HIGH' ELSE 'MEDIUM' END")
        else:
            cells.append(f"replace({lit(value)}, '@', feature)" if isinstance(value, str) else lit(value))
    names = ", ".join(ASSET_COLUMNS)
    return f"""{SPLIT}, {_screen('tr')}, zr AS ({zeros}),
li({names}) AS (VALUES {values}),
al AS (SELECT {names.replace('notes', '')} CASE WHEN z IS NOT NULL
         THEN 'Training rows with a zero denominator: ' || z || '.' ELSE notes END AS notes
       FROM li LEFT JOIN zr USING (feature_name)
       UNION ALL SELECT {', '.join(cells)} FROM screen WHERE pattern IN ({CURVED})),
plan AS (SELECT *, list_position([{GROUPS}], feature_group) AS g FROM al)"""


def _repository() -> str:
    kept = [
        "feature_name", "feature_group", "feature_subtype", "source_columns", "business_meaning", "creation_status",
        "used_by_machine_learning", "used_by_inference", "used_by_optimization", "used_by_grey_models",
        "requires_training_fit", "implementation_module", "priority", "analyst_decision",
    ]
    number = "row_number() OVER (ORDER BY g, priority, feature_name)"
    return (
        f"WITH {_plan()} SELECT printf('FEAT-%03d', {number}) AS feature_id, {', '.join(kept)}, "
        f"'PLANNED' AS repository_status FROM plan"
    )


def _dependencies() -> str:
    known = ", ".join(lit(c) for c in VARIABLES)
    return (
        f"WITH {_plan()}, ex AS (SELECT feature_name, feature_group, unnest(string_split(source_columns, ' | ')) "
        f"AS source_variable FROM plan) SELECT *, source_variable IN ({known}) AS "
        f"source_available_in_training_data FROM ex"
    )


def _plan_summary() -> str:
    return (
        f"WITH {_plan()} SELECT feature_group, count(*) AS features, "
        f"count(*) FILTER (analyst_decision IN ({READY})) AS ready, "
        f"count(*) FILTER (analyst_decision NOT IN ({READY})) AS needing_decision FROM plan GROUP BY feature_group"
    )


RECOMMENDED = (
    ("qty_per_line", "total_qty / line_count", "Average quantity per order line.", "DETERMINISTIC RATIO",
     "total_qty IS NOT NULL AND line_count <> 0"),
    ("parts_per_line", "part_count / line_count", "Distinct parts per order line.", "DETERMINISTIC RATIO",
     "part_count IS NOT NULL AND line_count <> 0"),
    ("qty_per_part", "total_qty / part_count", "Average quantity per distinct part.", "DETERMINISTIC RATIO",
     "total_qty IS NOT NULL AND part_count <> 0"),
    ("qty_line_interaction", "total_qty × line_count", "Order size and length may act together.",
     "EXPLORATORY INTERACTION", "total_qty IS NOT NULL AND line_count IS NOT NULL"),
    ("balance_segment_interaction", "cust_balance × indicators of segment", "Balance may count differently by segment.",
     "EXPLORATORY INTERACTION", "cust_balance IS NOT NULL AND segment IS NOT NULL"),
)


def _recommendations(source: str = "tr") -> str:
    rule = {"DETERMINISTIC RATIO": "Create automatically",
            "EXPLORATORY INTERACTION": "Evaluate as a candidate, not as a mandatory feature"}
    return "re AS (" + union(
        f"SELECT {lit(name)} AS recommended_feature, {lit(formula)} AS formula, {lit(meaning)} AS business_meaning, "
        f"{lit(kind)} AS recommendation_type, {lit(rule[kind])} AS implementation_rule, "
        f"'A zero denominator gives NULL; whatever is fitted is fitted on training rows.' AS caution, "
        f"count(*) FILTER ({usable}) AS usable_rows FROM {source}"
        for name, formula, meaning, kind, usable in RECOMMENDED
    ) + ")"


def _candidates() -> str:
    rows = union(
        f"SELECT '{c}' AS feature, '{SCHEMA().rule(c).semantic_type}' AS semantic_type" for c in VARIABLES if c != b.TARGET
    )
    return f"""WITH {SPLIT}, {_screen('tr')}, {_correlations(source='tr')}, {_outliers(source='tr')}, ba AS ({rows})
SELECT feature, semantic_type, 'May add to the other predictors; judge it together with them.' AS business_rationale,
  'No prior expectation; read the sign from the data.' AS expected_relationship, {r6('r')} AS correlation_with_target,
  CASE WHEN r IS NULL THEN 'Categorical predictor' WHEN abs(r) >= 0.5 THEN 'Strong marginal linear association'
    WHEN abs(r) >= 0.2 THEN 'Moderate marginal linear association'
    WHEN abs(r) >= 0.1 THEN 'Weak marginal linear association'
    ELSE 'Very weak marginal linear association' END AS observed_linear_association,
  coalesce(pattern, 'Not applicable') AS exploratory_nonlinearity,
  {r6('coalesce(pct, 0.0)')} AS potential_outlier_percentage, 'RETAIN AS CANDIDATE' AS candidate_status,
  'Prediction: keep what lowers validation error. Inference: keep what theory asks for and the data can estimate.'
    AS final_decision_rule
FROM ba LEFT JOIN tc USING (feature) LEFT JOIN screen USING (feature) LEFT JOIN osum ON variable = feature"""


def _challenges(ctes: str, source: str, target: str, measured: list[str], columns: list[str], located: bool) -> str:
    predictors = [c for c in measured if c != target]
    return f"""WITH {ctes}, {_screen(source, features=predictors, target=target)}, {_nulls(columns, source)},
{_pairs(predictors, source)}, {_outliers(measured, source)}, sk AS (SELECT {skew(target)} AS s FROM {source})
SELECT 'Statistics' AS challenge_group, 'Skewed response' AS challenge,
  format('Skewness of {target} is {{:.4f}}.', s) AS evidence,
  'Try a transformed response and keep it only if held-out error falls.' AS implication FROM sk WHERE abs(s) >= 0.75
UNION ALL SELECT 'Data', 'Gaps in predictors',
  'Columns with gaps: ' || string_agg(column_name, ', ' ORDER BY position) || '.',
  'Learn fill values on training rows and reuse them for every other row.' FROM nc WHERE missing > 0 HAVING count(*) > 0
UNION ALL SELECT 'Statistics', 'Collinear predictors',
  'Pairs of predictors with |r| of at least 0.80: ' || count(*) || '.',
  'Check whether coefficients can be told apart; prediction may use both columns.'
FROM cp WHERE abs(r) >= 0.8 HAVING count(*) > 0
UNION ALL SELECT 'Statistics', 'Curved relationships',
  'Not straight against the response: ' || string_agg(feature, ', ' ORDER BY score DESC, feature) || '.',
  'Compare a straight line with polynomial and spline terms on validation rows.'
FROM screen WHERE pattern IN ({CURVED}) HAVING count(*) > 0
UNION ALL SELECT 'Data', 'Outlying rows',
  'Columns with 5 % or more flagged rows: ' || string_agg(variable, ', ' ORDER BY pct DESC, variable) || '.',
  'Keep the rows, and refit without them to see how much rests on them.' FROM osum WHERE pct >= 5 HAVING count(*) > 0
UNION ALL SELECT 'Structure', 'Location effects', 'Rows carry latitude and longitude.',
  'Give location joint or regional terms instead of two separate slopes.' WHERE {located}"""


STRAINED = """sb AS (SELECT CASE WHEN block_id % 97 <> 0 THEN total_qty END AS total_qty, line_count, part_count, cust_balance,
  CASE WHEN block_id % 14 = 0 THEN 1000.0::DOUBLE + block_id % 7 ELSE (block_id % 7)::DOUBLE END AS spiked,
  block_id % 180 - 90.0::DOUBLE AS latitude, block_id * 7 % 360 - 180.0::DOUBLE AS longitude,
  power((cust_balance - 4500.0::DOUBLE) / 1000.0::DOUBLE, 4) AS strained_value FROM ob)"""
STRAINED_MEASURED = ["total_qty", "line_count", "part_count", "cust_balance", "spiked", "strained_value"]
STRAINED_COLUMNS = [*STRAINED_MEASURED[:-1], "latitude", "longitude", "strained_value"]


def _findings() -> str:
    t, gaps = b.TARGET, "SELECT string_agg(column_name, ', ' ORDER BY position) AS names FROM nc WHERE missing > 0"
    return f"""WITH {SPLIT}, {_nulls(VARIABLES, 'tr')}, {_correlations(source='tr')}, {_outliers(source='tr')}, {_logical('tr')},
ts AS (SELECT count({t}) AS n, avg({t}) AS m, {skew(t)} AS s FROM tr), gp AS ({gaps}),
n AS (
SELECT 'eda' AS section, 1 AS o, '{t} has ' || CASE WHEN s > 0.5 THEN 'a long right tail.' WHEN s < -0.5
  THEN 'a long left tail.' ELSE 'no long tail.' END AS note FROM ts
UNION ALL (SELECT 'eda', 2, format('{{}} follows the target most closely on a straight line (r = {{:.4f}}).', feature, r)
  FROM tc WHERE r IS NOT NULL ORDER BY abs(r) DESC, feature LIMIT 1)
UNION ALL SELECT 'eda', 3, 'At least 5 % of the rows are flagged in ' || string_agg(variable, ', ' ORDER BY pct DESC, variable)
  || '.' FROM osum WHERE pct >= 5 HAVING count(*) > 0
UNION ALL SELECT 'eda', 4, 'Gaps to be filled from training rows: ' || names || '.' FROM gp WHERE names IS NOT NULL
UNION ALL SELECT 'eda', 5, 'Associations here say nothing about causes.'
UNION ALL SELECT 'understanding', 1, coalesce('Incomplete columns: ' || names || '.', 'Every column is complete.') FROM gp
UNION ALL SELECT 'understanding', 2, coalesce('Logical checks to look into: ' || string_agg(check_name, ', ' ORDER BY check_name)
  || '.', 'Every logical check passes.') FROM lc WHERE n > 0
UNION ALL SELECT 'understanding', 3, 'So far nothing was changed.'
UNION ALL SELECT 'insight', 1, format('{t} is known for {{:,}} rows; its mean is {{:,.2f}}.', n, m) FROM ts
UNION ALL SELECT 'insight', 2, format('{t} is strongly skewed ({{:.2f}}).', s) FROM ts WHERE abs(s) > 1
UNION ALL (SELECT 'insight', 3, format('{{}} has the most gaps: {{:,}} rows.', column_name, missing)
  FROM nc WHERE missing > 0 ORDER BY missing DESC, column_name LIMIT 1)
UNION ALL SELECT 'insight', 3, 'There are no gaps.' FROM gp WHERE names IS NULL
UNION ALL SELECT 'insight', 4, format('{t} {{}} with cust_balance (r = {{:.3f}}).',
  CASE WHEN r > 0 THEN 'rises' ELSE 'falls' END, r) FROM tc WHERE feature = 'cust_balance' AND r IS NOT NULL
UNION ALL (SELECT 'insight', 5, format('The most frequent segment is {{}}.', segment)
  FROM tr WHERE segment IS NOT NULL GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1))
SELECT section, row_number() OVER (PARTITION BY section ORDER BY o)::INTEGER AS position, note FROM n"""


def _patterns() -> str:
    corr, cat, stated = PATTERNS

    def tail(p) -> str:
        return (
            f"{lit(p.explanation)} AS possible_explanation, {lit(p.implication)} AS business_implication, "
            f"{lit(p.caution)} AS inferential_caution"
        )

    return f"""WITH {SPLIT}, {_correlations(source='tr')},
cm AS (SELECT segment, avg({b.TARGET}) AS m FROM tr GROUP BY segment HAVING count({b.TARGET}) > 0)
SELECT {lit(corr.label)} AS feature_or_pattern,
  format('Correlation with the response = {{:.4f}}.', r) AS observed_pattern, {tail(corr)}
FROM tc WHERE feature = 'line_count'
UNION ALL SELECT {lit(cat.label)}, 'Highest mean response category: ' || max_by(segment, m) || '; lowest: '
  || min_by(segment, m) || '.', {tail(cat)} FROM cm
UNION ALL SELECT {lit(stated.label)}, {lit(stated.statement)}, {tail(stated)}"""


def _headline() -> str:
    return f"""WITH {SPLIT}, {_screen('tr')}, {_pairs(PREDICTORS, 'tr')}, {_recommendations()}
SELECT (SELECT count(*) FROM tr) AS training_observations, {len(VARIABLES) - 1} AS candidate_predictors,
  (SELECT count(*) FROM cp WHERE abs(r) >= {HIGH_PAIRWISE}) AS high_correlation_pairs,
  (SELECT count(*) FROM screen WHERE pattern IN ({CURVED})) AS curved_relationships,
  (SELECT coalesce(string_agg(feature, ', ' ORDER BY score DESC, feature), '') FROM screen WHERE pattern IN ({CURVED}))
    AS curved_features,
  (SELECT count(*) FROM re) AS engineered_features,
  (SELECT count(*) FROM re WHERE recommendation_type = 'DETERMINISTIC RATIO') AS ratio_features,
  (SELECT count(*) FROM re WHERE recommendation_type = 'EXPLORATORY INTERACTION') AS interaction_hypotheses"""


def _audit() -> str:
    rows = []
    schema = SCHEMA()
    rows.append("SELECT 'semantic_validation_gate' AS operation, '' AS \"column\", 0::BIGINT AS affected_observations, "
                "'FAILED' AS decision, 'Preprocessing proceeded only after semantic-schema validation.' AS description")
    rows.append("SELECT 'schema_column_selection', '', 2, 'SCHEMA COLUMNS RETAINED', "
                "'Unexpected columns excluded: block_id, remark'")
    for rule in schema.rules:
        kind = "string" if rule.storage == "string" else "bigint" if rule.whole_number else "double"
        count = "0"
        if rule.storage == "numeric":
            held = f"TRY_CAST({rule.name} AS DOUBLE)"
            bad = f"{held} IS NULL" + (f" OR {held} % 1 <> 0" if rule.whole_number else "")
            count = f"count(*) FILTER ({rule.name} IS NOT NULL AND ({bad}))"
        rows.append(f"SELECT 'dtype_alignment', '{rule.name}', {count}, '{kind}', "
                    f"'Storage type aligned with the semantic schema.' FROM ub" + ("" if count != "0" else " LIMIT 1"))
        if count == "0":
            rows[-1] = f"({rows[-1]})"
    rows.append("SELECT 'categorical_text_standardisation', 'segment', count(*) FILTER (trim(segment) <> segment), "
                "'WHITESPACE TRIMMED', 'Leading and trailing whitespace removed from non-missing category values.' "
                "FROM ub")
    gaps = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in VARIABLES)
    rows.append(f"SELECT 'missing_value_treatment', '', {gaps}, 'PRESERVED', 'Allowed missing values were retained. "
                f"Model-specific imputation must be fitted using training data only.' FROM cl")
    rows.append("SELECT 'row_count_check', '', 0, 'NO ROWS REMOVED', 'Raw rows=' || count(*) || '; processed rows=' "
                "|| count(*) || '.' FROM ub")
    return f"WITH {UNTIDY}\n" + union(rows)


UNTIDY = FAULTY + """,
ub AS (SELECT * REPLACE (CASE WHEN block_id % 97 = 0 THEN 'n/a' ELSE CAST(total_qty AS VARCHAR) END AS total_qty,
         '  ' || segment || ' ' AS segment), 'free text' AS remark FROM fb),
cl AS (SELECT block_id, CASE WHEN TRY_CAST(total_qty AS DOUBLE) % 1 = 0 THEN TRY_CAST(total_qty AS DOUBLE)::BIGINT END AS total_qty,
         CASE WHEN part_count % 1 = 0 THEN part_count::BIGINT END AS part_count, supp_count, line_count, cust_balance, gross_value,
         trim(segment) AS segment FROM ub)"""


#: Order lines with a category of thousands of levels, and the numbers of its training levels.
WIDE_LINES = """wl AS (SELECT l_orderkey, l_linenumber, l_orderkey % 5 <> 0 AS trained,
  CASE WHEN l_orderkey % 83 <> 0 THEN l_partkey || '/' || l_suppkey END AS part_supplier FROM lineitem),
lv AS (SELECT part_supplier, row_number() OVER (ORDER BY part_supplier) - 1 AS level_number
  FROM (SELECT DISTINCT part_supplier FROM wl WHERE trained AND part_supplier IS NOT NULL))"""


def _one_hot() -> str:
    # Level names are data, but the five segments are the known levels of this table.
    made = ", ".join(
        f"CASE WHEN segment = '{s}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"segment_{s}\"" for s in b.SEGMENTS[1:]
    )
    return f"""WITH {SPLIT},
x AS (SELECT block_id, split, line_count, CASE WHEN split = 'test' AND block_id % 89 = 0 THEN 'NEW'
        WHEN block_id % 83 <> 0 THEN segment END AS segment FROM sp)
SELECT block_id, split, line_count, {made} FROM x"""


def _prepared_cte() -> str:
    numbers = [c for c in b.SELECTED if c != "segment"]
    fit = ", ".join(f"median(CAST({c} AS DOUBLE)) AS md_{c}" for c in numbers)
    filled = ", ".join(f"coalesce(CAST({c} AS DOUBLE), md_{c}, 0.0) AS {c}" for c in numbers)
    dummies = ", ".join(
        f"CASE WHEN segment = '{s}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"segment_{s}\"" for s in b.SEGMENTS[1:]
    )
    return f"""{SPLIT},
rt AS (SELECT *, total_qty / nullif(line_count, 0) AS qty_per_line FROM sp WHERE {b.TARGET} IS NOT NULL),
mf AS (SELECT {fit} FROM rt WHERE split = 'train'),
pp AS (SELECT block_id, split, {filled}, {dummies}, {b.TARGET} FROM rt, mf)"""


def _layout() -> list[str]:
    return [c for c in b.SELECTED if c != "segment"] + [f"segment_{s}" for s in b.SEGMENTS[1:]]


def _preprocessed() -> str:
    shown = ", ".join(f'{r6(chr(34) + c + chr(34))} AS "{c}"' for c in [*_layout(), b.TARGET])
    return f"WITH {_prepared_cte()} SELECT block_id, split, {shown} FROM pp"


def _feature_names() -> str:
    return f"WITH {_prepared_cte()}\n" + union(
        f"SELECT {i} AS position, '{c}' AS feature_name, count(*) FILTER (\"{c}\" <> 0) AS non_zero_rows "
        f"FROM pp WHERE split = 'train'"
        for i, c in enumerate(_layout(), start=1)
    )


def _block_rounded(source="ob") -> str:
    doubles = ("total_qty", "cust_balance", "gross_value")
    return ", ".join(f"{r6(c)} AS {c}" if c in doubles else c for c in BLOCK_COLUMNS)


def _squared() -> str:
    made = ", ".join(f"{r6(f'CAST({c} AS DOUBLE) * {c}')} AS {c}_squared" for c in b.NUMBERS)
    return f"WITH {BLOCK} SELECT block_id, {made} FROM ob"


def _polynomial() -> str:
    columns = ["total_qty", "line_count", "supp_count"]
    made = []
    for i, x in enumerate(columns):
        for y in columns[i:]:
            name = f"{x}^2" if x == y else f"{x}*{y}"
            made.append(f'{r6(f"CAST({x} AS DOUBLE) * CAST({y} AS DOUBLE)")} AS "{name}"')
    return f"WITH {BLOCK} SELECT block_id, {', '.join(made)} FROM ob"


def _interactions() -> str:
    levels = ", ".join(
        f"CASE WHEN segment = '{s}' THEN {r6('cust_balance')} ELSE 0.0::DOUBLE END AS \"balance_segment_{s}\""
        for s in b.SEGMENTS
    )
    return (
        f"WITH {BLOCK} SELECT block_id, {r6('total_qty * line_count')} AS qty_x_lines, "
        f"{r6('cust_balance * line_count')} AS balance_x_lines, {levels} FROM ob"
    )


def _histogram(bins: int = 50) -> str:
    return f"""WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
g AS (SELECT unnest(range({bins}))::INTEGER AS bin),
c AS (SELECT least(floor((value - lo) / ((hi - lo) / {bins})), {bins - 1})::INTEGER AS bin, count(*) AS n
      FROM events, e GROUP BY 1)
SELECT g.bin, {r6(f'lo + g.bin * ((hi - lo) / {bins})')} AS bin_low,
  {r6(f'lo + (g.bin + 1) * ((hi - lo) / {bins})')} AS bin_high, coalesce(n, 0) AS frequency
FROM g LEFT JOIN c USING (bin), e"""


def _boxplot() -> str:
    return f"""WITH {BLOCK}, {_outliers()}
SELECT variable, {r6('any_value(q1)')} AS q1, {r6('median(x)')} AS median, {r6('any_value(q3)')} AS q3,
  {r6('min(x) FILTER (NOT by_fence)')} AS whisker_low, {r6('max(x) FILTER (NOT by_fence)')} AS whisker_high,
  count(*) FILTER (by_fence) AS flier_count FROM flags GROUP BY variable"""


def _matrix(columns, source: str) -> str:
    return f"""{_pairs(columns, source)},
mx AS (SELECT i, j, f1, f2, r FROM cp UNION ALL SELECT j, i, f2, f1, r FROM cp UNION ALL
  {union(f"SELECT {i}, {i}, '{c}', '{c}', CASE WHEN var_pop({c}) > 0 THEN 1.0 END FROM {source}"
         for i, c in enumerate(columns, start=1))})"""


def _describe() -> str:
    def r3(x: str) -> str:
        return f"round({x}, 3)"

    return f"""WITH {BLOCK}, lg AS ({long(MEASURED)})
SELECT variable, count(x) AS value_count, {r3('avg(x)')} AS mean, {r3('median(x)')} AS median,
  {r3('stddev_samp(x)')} AS std, {r3('min(x)')} AS min, {r3('quantile_cont(x, 0.25)')} AS q25,
  {r3('median(x)')} AS q50, {r3('quantile_cont(x, 0.75)')} AS q75, {r3('max(x)')} AS max,
  count(*) - count(x) AS missing FROM lg GROUP BY variable"""


def _distribution(columns, source="ob", cte=BLOCK) -> str:
    head = f"WITH {cte}, " if cte else "WITH "
    return f"""{head}lg AS ({long(columns, source)})
SELECT variable, {MOMENTS}, {_shape(skew('x'))} AS distribution_shape FROM lg GROUP BY variable"""


def _target_statistics() -> str:
    t = b.TARGET
    named = {
        "Mean": f"avg({t})", "Median": f"median({t})", "Standard Deviation": f"stddev_samp({t})",
        "Minimum": f"min({t})", "Maximum": f"max({t})", "Skewness": skew(t),
    }
    return f"WITH {BLOCK}\n" + union(
        f"SELECT '{k}' AS statistic, round({v}, 3) AS value FROM ob" for k, v in named.items()
    )


def _screen_result() -> str:
    texts = "".join(f"WHEN pattern = {lit(k)} THEN {lit(v)} " for k, v in curvature.IMPLICATIONS.items())
    return f"""WITH {BLOCK}, {_screen()}
SELECT feature, {r6('score')} AS deviation_score, pattern AS automated_screen,
  'Bin means against the fitted line' AS visual_evidence, 'Not reviewed' AS analyst_decision,
  CASE {texts}END AS provisional_model_implication,
  {lit(curvature.SCREEN_CAUTION)} AS caution, pattern AS exploratory_pattern FROM screen"""


def _lowess_robust(rounds: int = 2, cells: int = 100, spike: int = 40) -> str:
    """The local regression with rounds of bisquare weights, over the spiked table."""
    sql = _screen("sb", bins=cells)
    start, stop = sql.index("ms AS ("), sql.index("sc AS (")
    local = [
        """pa AS (SELECT a.feature, a.bin AS place, a.ax AS x0, b.bin AS other, b.m, abs(b.ax - a.ax) AS away,
  sum(b.m) OVER (PARTITION BY a.feature, a.bin ORDER BY abs(b.ax - a.ax)) AS upto,
  sum(b.m) OVER (PARTITION BY a.feature, a.bin) AS every FROM bn a JOIN bn b USING (feature)),
re AS (SELECT feature, place, min(away) FILTER (upto >= 0.25::DOUBLE * every) AS reach FROM pa GROUP BY feature, place),
nb AS (SELECT feature, place, x0, other, power(1 - power(coalesce(away / nullif(reach, 0), 0), 3), 3) AS t
  FROM pa JOIN re USING (feature, place) WHERE away <= reach),
br AS (SELECT feature, len(list_filter(list_distinct(edges), lambda e: e < x)) AS bin, x, y FROM pr JOIN ln USING (feature)),
fx0 AS (SELECT feature, bin, m::DOUBLE AS mass, ax AS gx, ay AS gy FROM bn)"""
    ]
    for r in range(rounds + 1):
        local.append(
            f"""fi{r} AS (SELECT nb.feature, place, nullif(sum(t * mass), 0) AS w, sum(t * mass * (gx - x0)) AS wd,
  sum(t * mass * (gx - x0) * (gx - x0)) AS wdd, sum(t * mass * gy) AS wy, sum(t * mass * (gx - x0) * gy) AS wdy
  FROM nb JOIN fx{r} ON fx{r}.feature = nb.feature AND fx{r}.bin = nb.other WHERE mass > 0 GROUP BY nb.feature, place),
sl{r} AS (SELECT feature, place AS bin, w, wd, wy, CASE WHEN wdd - wd * wd / w <= 1e-12::DOUBLE * wdd THEN 0
  ELSE (wdy - wd * wy / w) / (wdd - wd * wd / w) END AS bend FROM fi{r}),
cu{r} AS (SELECT feature, bin, (wy - bend * wd) / w AS curve, bend FROM sl{r})"""
        )
        if r < rounds:
            local.append(
                f"""rs{r} AS (SELECT br.*, abs(y - curve - bend * (x - ax)) AS far
  FROM br JOIN cu{r} USING (feature, bin) JOIN bn USING (feature, bin)),
md{r} AS (SELECT feature, 6.0::DOUBLE * median(far) AS scale FROM rs{r} GROUP BY feature),
rw{r} AS (SELECT feature, bin, x, y, power(1 - power(least(far / scale, 1), 2), 2) AS w FROM rs{r} JOIN md{r} USING (feature)),
fx{r + 1} AS (SELECT feature, bin, sum(w) AS mass, sum(w * x) / nullif(sum(w), 0) AS gx, sum(w * y) / nullif(sum(w), 0) AS gy
  FROM rw{r} GROUP BY feature, bin)"""
            )
    local.append(
        f"""ms AS (SELECT feature, sum(m * power(curve - (my - slope * mx + slope * ax), 2)) / sum(m) AS msq
  FROM bn JOIN cu{rounds} USING (feature, bin) JOIN ln USING (feature) GROUP BY feature),
"""
    )
    spiked = f"sb AS (SELECT * REPLACE ({b.TARGET} * CASE WHEN block_id % 61 = 0 THEN {spike} ELSE 1 END AS {b.TARGET}) FROM ob), "
    return _screen_result().replace(_screen(), spiked + sql[:start] + ",\n".join(local) + sql[stop:])


def _scatter() -> str:
    # The counts of lines, parts and suppliers are the columns most correlated with the target.
    return f"""WITH {BLOCK}
SELECT block_id, line_count, part_count, supp_count, {r6(b.TARGET)} AS {b.TARGET}
FROM ob ORDER BY md5(block_id::VARCHAR || '#42'), block_id LIMIT 1000"""


def _fingerprint(source: str, columns: list[tuple[str, str, str]], shown: str = "n AS row_total, fingerprint") -> str:
    """Length-prefixed fields, MD5 per row, sums of its four slices, MD5 with names and types.

    Decimals do not occur and the doubles printed here have two decimals, which print plainly.
    """
    fields = " || ".join(f"coalesce(length({text}) || ':' || {text}, '~')" for _, _, text in columns)
    header = "".join(f"{len(name)}:{name} {kind};" for name, kind, _ in columns)
    slices = ", ".join(f"coalesce(sum(('0x' || substr(h, {1 + 8 * i}, 8))::BIGINT), 0)::VARCHAR AS p{i}" for i in range(4))
    return f"""SELECT {shown} FROM (SELECT n, md5('{header}-' || n::VARCHAR || '-' || p0 || '-' || p1 || '-' || p2
  || '-' || p3) AS fingerprint FROM (SELECT count(*) AS n, {slices} FROM (SELECT md5({fields}) AS h FROM {source})))"""


def _pipeline() -> str:
    """Each stage's SQL, fingerprinted over the columns that both engines print alike."""
    known = {"long": "bigint", "int": "int", "text": "string"}

    def columns(**kinds: str) -> list[tuple[str, str, str]]:
        return [(n, known[k], f'"{n}"' if k == "text" else f'"{n}"::VARCHAR') for n, k in kinds.items()]

    plain_issues = _issues("ob", VARIABLES, "")
    found = {
        "validation_issues": (
            f"WITH {BLOCK}, {plain_issues} SELECT * FROM iss",
            columns(severity="text", rule="text", column="text", affected_count="long", message="text"),
        ),
        "split_audit": (
            f"WITH {SPLIT} SELECT split, stratum, count(*) AS observations FROM sp GROUP BY split, stratum",
            columns(split="text", stratum="int", observations="long"),
        ),
        "logical_checks": (
            f"WITH {SPLIT}, {_logical('tr')} SELECT check_name, n AS affected_observations, "
            "CASE WHEN n = 0 THEN 'PASS' ELSE 'REVIEW' END AS status FROM lc",
            columns(check_name="text", affected_observations="long", status="text"),
        ),
        "correlation_screen": (
            f"WITH {SPLIT}, {_pairs(PREDICTORS, 'tr')} SELECT f1 AS feature_1, f2 AS feature_2 FROM cp "
            f"WHERE abs(r) >= {HIGH_PAIRWISE}",
            columns(feature_1="text", feature_2="text"),
        ),
        "outlier_summary": (
            f"WITH {SPLIT}, {_outliers(source='tr')} SELECT variable, f AS iqr_flag_count, s AS modified_z_flag_count, "
            "c AS combined_flag_count FROM osum",
            columns(variable="text", iqr_flag_count="long", modified_z_flag_count="long", combined_flag_count="long"),
        ),
        "curvature_screen": (
            f"WITH {SPLIT}, {_screen('tr')} SELECT feature, pattern AS automated_screen FROM screen",
            columns(feature="text", automated_screen="text"),
        ),
        "candidate_variables": (
            _candidates(), columns(feature="text", observed_linear_association="text", exploratory_nonlinearity="text"),
        ),
        "modelling_challenges": (
            _challenges(SPLIT, "tr", b.TARGET, MEASURED, VARIABLES, False), columns(challenge="text", evidence="text"),
        ),
        "notes": (_findings(), columns(section="text", position="int", note="text")),
        "feature_repository": (
            _repository(),
            columns(feature_id="text", feature_name="text", source_columns="text", priority="text", analyst_decision="text"),
        ),
        "feature_dependencies": (_dependencies(), columns(feature_name="text", source_variable="text")),
        "splits": (
            f"WITH {SPLIT} SELECT block_id, stratum, split FROM sp",
            columns(block_id="long", stratum="int", split="text"),
        ),
        "prepared": (
            f"WITH {SPLIT} SELECT block_id, split FROM sp WHERE {b.TARGET} IS NOT NULL", columns(block_id="long", split="text"),
        ),
    }
    return union(
        f"SELECT '{stage}' AS stage, row_total, fingerprint FROM ({_fingerprint(f'({sql})', shown)})"
        for stage, (sql, shown) in found.items()
    )


def _wide() -> str:
    powers = [f"power({c} / 100.0::DOUBLE, {p}) AS {c}_{p}" for p in (2, 3) for c in MEASURED]
    others = ", ".join(f"{c}::DOUBLE AS {c}" for c in MEASURED if c != "total_qty")
    names = [*MEASURED, *[f"{c}_{p}" for p in (2, 3) for c in MEASURED], "unit"]
    return f"""WITH {BLOCK}, wb AS (SELECT CASE WHEN block_id % 11 <> 0 THEN total_qty END AS total_qty, {others},
  {', '.join(powers)}, 1.0::DOUBLE AS unit FROM ob), {_matrix(names, 'wb')}
SELECT f1 AS feature_1, f2 AS feature_2, {r6('r')} AS correlation FROM mx"""


def oracles() -> dict[str, str]:
    """Query name to SQL. Queries without exact SQL (tree models, local regression) are left out."""
    schema = SCHEMA()
    declared = ", ".join(
        f"({lit(r.name)}, {lit(r.nullable)}, {lit(r.missing_treatment)})" for r in schema.rules
    )
    quantity = "total_qty / nullif(line_count, 0)"
    moments = [*b.NUMBERS, b.TARGET]
    weights = {"total_qty": 0.5, "line_count": 0.3, "cust_balance": 0.2}
    found = {
        "scan_normalised": f"""SELECT event_id, user_id, event_type,
  CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 THEN NULL ELSE {r6('value')} END AS value FROM events""",
        "dataset_fingerprint": _fingerprint(
            "orders",
            [
                ("o_orderkey", "bigint", "o_orderkey::VARCHAR"), ("o_custkey", "bigint", "o_custkey::VARCHAR"),
                ("o_orderstatus", "string", "o_orderstatus"), ("o_totalprice", "double", "o_totalprice::VARCHAR"),
                ("o_orderdate", "timestamp_ntz", "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f')"),
                ("o_orderpriority", "string", "o_orderpriority"),
            ],
            "n AS row_total, 6::BIGINT AS column_total, fingerprint",
        ),
        "coerce_numeric": f"""SELECT event_id, CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0
  OR event_type = 'error' THEN NULL ELSE {r6('value')} END AS value FROM events""",
        "schema_clean": f"WITH {UNTIDY} SELECT block_id, total_qty, part_count, supp_count, line_count, "
                        f"{r6('cust_balance')} AS cust_balance, {r6('gross_value')} AS gross_value, segment FROM cl",
        "preprocessing_audit": _audit(),
        "preview": f"WITH {BLOCK} SELECT {_block_rounded()} FROM ob ORDER BY block_id LIMIT 10",
        "validation_issues": f"WITH {FAULTY}, {_issues()} SELECT {ISSUES} FROM iss",
        "validation_observations": _observations(),
        "minimum_bound_observations": _observations(("minimum_bound",)),
        "validation_summary": f"""WITH {FAULTY}, {_issues()}, {_nulls(BLOCK_COLUMNS, 'fb')}
SELECT (SELECT max(n) FROM nc) AS observations, {len(BLOCK_COLUMNS)} AS "columns",
  count(*) FILTER (severity = 'ERROR') AS validation_errors,
  count(*) FILTER (severity = 'WARNING') AS validation_warnings,
  coalesce(max(CASE WHEN rule = 'duplicate_rows' THEN affected_count END), 0)::BIGINT AS duplicate_rows,
  (SELECT sum(missing)::BIGINT FROM nc) AS total_missing_values,
  CASE WHEN count(*) FILTER (severity = 'ERROR') > 0 THEN 'FAILED'
    WHEN count(*) FILTER (severity = 'WARNING') > 0 THEN 'PASSED WITH WARNINGS' ELSE 'PASSED' END AS status FROM iss""",
        "logical_checks": f"""WITH {FAULTY}, {_logical()}
SELECT check_name, n AS affected_observations, CASE WHEN n = 0 THEN 'PASS' ELSE 'REVIEW' END AS status, description
FROM lc""",
        "dataset_summary": f"""WITH {FAULTY}, {_nulls(BLOCK_COLUMNS, 'fb')}
SELECT 'Training' AS dataset, max(n) AS observations, {len(BLOCK_COLUMNS)} AS variables,
  {len(schema.numerical)} AS numerical_predictors, {len(schema.categorical)} AS categorical_predictors,
  '{b.TARGET}' AS target_column, sum(missing)::BIGINT AS total_missing_values,
  count(*) FILTER (missing > 0) AS variables_with_missing_values, {DUPLICATES} AS duplicate_rows,
  {r6(f'100.0 * {DUPLICATES} / max(n)')} AS duplicate_percentage FROM nc""",
        "column_profile": _column_profile(),
        "datetime_candidates": """WITH c AS (
  SELECT 'o_orderstatus' AS column_name, o_orderstatus AS t FROM orders
  UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders
  UNION ALL SELECT 'order_day', strftime(o_orderdate, '%Y-%m-%d') FROM orders
  UNION ALL SELECT 'mixed_day', CASE WHEN o_orderkey % 5 <> 0 THEN strftime(o_orderdate, '%m/%d/%Y') ELSE 'unknown' END
    FROM orders),
p AS (SELECT column_name, count(*) AS tested_values,
        count(coalesce(try_strptime(t, '%Y-%m-%d'), try_strptime(t, '%m/%d/%Y'))) AS parsed_values
      FROM c WHERE t IS NOT NULL GROUP BY column_name)
SELECT *, parsed_values::DOUBLE / tested_values >= 0.9 AS datetime_candidate FROM p""",
        "precise_values": """SELECT CASE o_orderkey % 6 WHEN 0 THEN 0.1::DOUBLE + 0.2::DOUBLE WHEN 1 THEN 0.3::DOUBLE
  WHEN 2 THEN 1e-20::DOUBLE WHEN 3 THEN 2e-20::DOUBLE ELSE 0.0::DOUBLE END AS number, count(*) AS frequency,
  5::BIGINT AS unique_count FROM orders GROUP BY 1""",
        "unexpected_values": """SELECT 'user' AS "column", user_id::VARCHAR AS value, count(*) AS affected_count
FROM events WHERE user_id NOT IN (1, 2, 3) GROUP BY user_id""",
        "categorical_candidates": f"""WITH {FAULTY}, {_frequencies(BLOCK_COLUMNS, 'fb')},
t AS (SELECT column_name, count(v) AS u, sum(n) FILTER (v IS NOT NULL) AS present, sum(n) AS total
      FROM vf GROUP BY column_name)
SELECT column_name, coalesce(v, '{MISSING_LABEL}') AS observed_value, n AS frequency,
  {r6('100.0 * n / total')} AS percentage
FROM vf JOIN t USING (column_name) WHERE u > 0 AND (u <= 20 OR u::DOUBLE / present <= 0.05)""",
        "example_values": f"WITH {BLOCK}, {_frequencies(BLOCK_COLUMNS, 'ob')}, {EXAMPLES} SELECT * FROM ex",
        "variable_summary": _variable_summary(),
        "duplicate_rows": f"WITH {FAULTY} SELECT {DUPLICATES} AS duplicate_rows",
        "missing_summary": f"""WITH {FAULTY}, {_nulls(BLOCK_COLUMNS, 'fb')},
d(column_name, nullable, treatment) AS (VALUES {declared})
SELECT column_name, missing AS missing_count, {r6('100.0 * missing / n')} AS missing_percentage,
  coalesce(nullable, FALSE) AS nullable_in_schema, coalesce(treatment, '') AS documented_treatment
FROM nc LEFT JOIN d USING (column_name) WHERE missing > 0""",
        "missing_table": f"""WITH {FAULTY}, {_nulls(BLOCK_COLUMNS, 'fb')}
SELECT column_name AS feature, missing AS missing_count, round(100.0 * missing / n, 2) AS missing_percentage FROM nc""",
        "categorical_frequencies": union(
            f"SELECT '{c}' AS column_name, coalesce({c}, '{MISSING_LABEL}') AS category_level, count(*) AS frequency, "
            f"{r6('100.0 * count(*) / (SELECT count(*) FROM documents)')} AS percentage FROM documents GROUP BY {c}"
            for c in ("lang", "source")
        ),
        "structure_table": f"WITH {FAULTY}\n" + union(
            f"SELECT '{c}' AS column_name, '{'double' if c == 'part_count' else TYPES[c]}' AS data_type, "
            f"count(*) - count({c}) AS missing_values, "
            f"round(100.0 * (count(*) - count({c})) / count(*), 2) AS missing_percentage, "
            f"count(DISTINCT {c}) AS unique_values FROM fb"
            for c in BLOCK_COLUMNS
        ),
        "value_counts": f"""WITH {FAULTY} SELECT segment AS value, count(*) AS value_count,
  round(100.0 * count(*) / (SELECT count(*) FROM fb), 2) AS percentage FROM fb GROUP BY segment""",
        "describe_numeric": _describe(),
        "target_statistics": _target_statistics(),
        "distribution_summary": _distribution(MEASURED),
        "lineitem_distribution": _distribution(
            ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "lineitem", ""
        ),
        "correlation_matrix": f"""WITH {BLOCK_UNIT}, {_matrix(MATRIX_COLUMNS, 'ou')}
SELECT f1 AS feature_1, f2 AS feature_2, {r6('r')} AS correlation FROM mx""",
        "correlation_wide": _wide(),
        "pipeline_summary": _pipeline(),
        "ridge_normal_equations": union(f"SELECT '{n}' AS feature, 0.0::DOUBLE AS gap" for n in ["(intercept)", *_layout()]),
        "validation_issues_all_rules": f"""WITH {BLOCK}
SELECT 'ERROR' AS severity, 'required_columns' AS rule, '' AS "column", 1 AS affected_count, 'Missing columns: not_there' AS message
UNION ALL SELECT 'ERROR', 'maximum_bound', 'line_count', count(*), 'Values above maximum 5.0.' FROM ob WHERE line_count > 5
UNION ALL SELECT 'ERROR', 'storage_type', 'segment', count(*), 'Expected numeric; observed string.' FROM ob
UNION ALL SELECT 'ERROR', 'storage_type', 'total_qty', count(*), 'Expected string; observed double.' FROM ob
UNION ALL SELECT 'ERROR', 'missing_values', 'segment', count(*), 'Missing values found in non-nullable column.' FROM ob
  WHERE segment IS NULL HAVING count(*) > 0
UNION ALL SELECT 'ERROR', 'missing_values', 'total_qty', count(*), 'Missing values found in non-nullable column.' FROM ob
  WHERE total_qty IS NULL HAVING count(*) > 0""",
        "correlation_heatmap": f"""WITH {BLOCK}, {_matrix(MEASURED, 'ob')}
SELECT i AS row_index, j AS column_index, f1 AS feature_1, f2 AS feature_2, {r6('round(r, 3)')} AS correlation FROM mx""",
        "target_correlations": f"""WITH {BLOCK}, {_correlations()}
SELECT feature, {r6('r')} AS correlation_with_target, {r6('abs(r)')} AS absolute_correlation FROM tc""",
        "correlation_screen": f"""WITH {BLOCK}, {_pairs(PREDICTORS)}
SELECT f1 AS feature_1, f2 AS feature_2, {r6('r')} AS correlation, {r6('abs(r)')} AS absolute_correlation,
  'High pairwise association' AS eda_interpretation,
  'Retain initially. Predictive models may use both variables if validation performance benefits.'
    AS machine_learning_implication,
  'Do not remove at EDA stage. Assess VIF, condition number, estimability, and theory before coefficient interpretation.'
    AS inferential_implication FROM cp WHERE abs(r) >= {HIGH_PAIRWISE}""",
        "categorical_target_summary": f"""WITH {FAULTY}
SELECT 'segment' AS categorical_variable, segment AS category_level, count({b.TARGET}) AS observations,
  {r6(f'avg({b.TARGET})')} AS target_mean, {r6(f'median({b.TARGET})')} AS target_median,
  {r6(f'stddev_samp({b.TARGET})')} AS target_standard_deviation FROM fb GROUP BY segment""",
        "outlier_summary": f"""WITH {BLOCK}, {_outliers()}
SELECT variable, {r6('q1')} AS q1, {r6('q3')} AS q3, {r6('iqr')} AS iqr, {r6('lo')} AS iqr_lower_bound,
  {r6('hi')} AS iqr_upper_bound, f AS iqr_flag_count, s AS modified_z_flag_count, c AS combined_flag_count,
  {r6('pct')} AS combined_flag_percentage FROM osum""",
        "outlier_iqr_only": f"""WITH {_outliers(['n_chars'], 'documents')}
SELECT variable, f AS combined_flag_count, {r6('100.0 * f / (SELECT count(*) FROM documents)')}
  AS combined_flag_percentage FROM osum""",
        "outlier_observations": f"""WITH {BLOCK}, {_outliers()}
SELECT variable AS outlier_variable, by_fence AS iqr_flag, by_score AS modified_z_flag,
  {r6('score')} AS modified_z_score, {_block_rounded()} FROM flags WHERE by_fence OR by_score""",
        "histogram": _histogram(),
        "boxplot_stats": _boxplot(),
        "scatter_sample": _scatter(),
        "grid_map": f"""WITH {BLOCK}
SELECT floor(cust_balance / 1000.0)::INTEGER AS cell_x, floor(total_qty / 25.0)::INTEGER AS cell_y,
  count(*) AS observations, {r6(f'avg({b.TARGET})')} AS mean_value FROM ob
WHERE cust_balance IS NOT NULL AND total_qty IS NOT NULL GROUP BY 1, 2""",
        "curvature_binned": _screen_result(),
        "lowess_screen": _lowess_robust(rounds=curvature.ROBUST_ROUNDS, spike=1),
        "lowess_robust": _lowess_robust(),
        "lowess_robust_narrowed": _lowess_robust(cells=20),
        "candidate_variables": _candidates(),
        "modelling_challenges": _challenges(SPLIT, "tr", b.TARGET, MEASURED, VARIABLES, False),
        "modelling_challenges_all": _challenges(
            f"{BLOCK}, {STRAINED}", "sb", "strained_value", STRAINED_MEASURED, STRAINED_COLUMNS, True
        ),
        "eda_findings": _findings(),
        "pattern_summary": _patterns(),
        "eda_headline": _headline(),
        "stratum_counts": f"""WITH {BLOCK} SELECT {_bins(b.STRATUM)} AS stratum, count(*) AS observations,
  {r6('100.0 * count(*) / (SELECT count(*) FROM ob)')} AS percentage FROM ob GROUP BY 1""",
        "stratified_split": f"WITH {SPLIT} SELECT block_id, stratum, split FROM sp",
        "split_audit": f"""WITH {SPLIT} SELECT split, stratum, count(*) AS observations,
  {r6('100.0 * count(*) / (SELECT count(*) FROM sp)')} AS percentage FROM sp GROUP BY split, stratum""",
        "ratio_features": f"WITH {BLOCK} SELECT block_id, " + ", ".join(
            f"{r6(f'CAST({r.numerator} AS DOUBLE) / nullif({r.denominator}, 0)')} AS {r.name}" for r in b.RATIOS
        ) + " FROM ob",
        "ratio_audit": f"WITH {BLOCK}, z AS (" + union(
            f"SELECT '{r.name}' AS feature_name, '{r.denominator}' AS denominator, "
            f"count(*) FILTER ({r.denominator} = 0) AS zero_denominators, "
            f"count(*) FILTER ({r.denominator} IS NULL) AS missing_denominators FROM ob"
            for r in b.RATIOS
        ) + """) SELECT *, CASE WHEN zero_denominators = 0 THEN 'No zero denominators detected in training data.'
  ELSE zero_denominators || ' zero denominator(s) detected in training data.' END AS note FROM z""",
        "interaction_features": _interactions(),
        "squared_features": _squared(),
        "centered_features": _fitted(
            None, {f"{c}_centered": f"{c} - m_{c}" for c in ("total_qty", "cust_balance")},
            _moment_fit(["total_qty", "cust_balance"]),
        ),
        "standardized_features": _fitted(
            None, {f"{c}_standardized": f"({c} - m_{c}) / s_{c}" for c in moments}, _moment_fit(moments)
        ),
        "spline_features": _spline(),
        "orthogonal_poly": _orthogonal(),
        "composite_index": _fitted(
            None,
            {"composite_index": " + ".join(f"{w} * ({c} - m_{c}) / s_{c}" for c, w in weights.items())},
            _moment_fit(list(weights)),
        ),
        "polynomial_features": _polynomial(),
        "category_groups": f"""WITH {BLOCK} SELECT block_id, segment,
  CASE WHEN segment IN ('FURNITURE', 'HOUSEHOLD', 'BUILDING') THEN 'HOME' ELSE 'OTHER' END AS segment_group FROM ob""",
        "nearest_distance": _nearest(),
        "nearest_point": _nearest_point(),
        "feature_recommendations": f"WITH {SPLIT}, {_recommendations()} SELECT * FROM re",
        "feature_plan": f"WITH {_plan()} SELECT {', '.join(ASSET_COLUMNS)} FROM plan",
        "feature_repository": _repository(),
        "feature_dependencies": _dependencies(),
        "feature_plan_summary": _plan_summary(),
        "drop_null_target": f"WITH {BLOCK} SELECT {_block_rounded()} FROM ob WHERE {b.TARGET} IS NOT NULL",
        "selected_features": f"""WITH {BLOCK} SELECT block_id, {r6('total_qty')} AS total_qty, part_count, supp_count,
  line_count, {r6('cust_balance')} AS cust_balance, segment, {r6(quantity)} AS qty_per_line,
  {r6(b.TARGET)} AS {b.TARGET} FROM ob""",
        "align_columns": f"""WITH {BLOCK} SELECT block_id, line_count, 0.0::DOUBLE AS absent_column,
  {r6('total_qty')} AS total_qty FROM ob""",
        "one_hot": _one_hot(),
        "one_hot_wide": f"""WITH {WIDE_LINES} SELECT l_orderkey, l_linenumber, level_number AS part_supplier_level_number
  FROM wl LEFT JOIN lv USING (part_supplier)""",
        "sparse_features": f"""WITH {WIDE_LINES} SELECT 0::BIGINT AS place, 'l_quantity' AS feature
  UNION ALL SELECT level_number, 'part_supplier_' || part_supplier FROM lv WHERE level_number > 0""",
        "ridge_wide": f"""WITH {WIDE_LINES} SELECT 'part_supplier_' || part_supplier AS feature, true AS met FROM lv
  WHERE level_number > 0""",
        "median_impute": f"""WITH {SPLIT}, mf AS (SELECT median(total_qty) AS q, median({b.TARGET}) AS t FROM tr)
SELECT block_id, split, {r6('coalesce(total_qty, q)')} AS total_qty, {r6(f'coalesce({b.TARGET}, t)')} AS {b.TARGET},
  0.0::DOUBLE AS empty_column FROM sp, mf""",
        "grown_tree": f"""WITH {BLOCK}, g AS (SELECT block_id, avg({b.TARGET}) OVER (PARTITION BY line_count, total_qty) AS p
  FROM ob WHERE {b.TARGET} IS NOT NULL) SELECT block_id, {r6('p')} AS prediction FROM g""",
        "preprocessed_splits": _preprocessed(),
        "feature_names": _feature_names(),
        "regression_metrics": f"""WITH {BLOCK}, e AS (SELECT o_orderstatus, o_totalprice AS a, {b.TARGET} AS p
  FROM orders JOIN ob ON o_orderkey = block_id WHERE o_totalprice IS NOT NULL AND {b.TARGET} IS NOT NULL)
SELECT o_orderstatus, {r6('sqrt(avg(power(a - p, 2)))')} AS rmse, {r6('avg(abs(a - p))')} AS mae,
  {r6('1 - sum(power(a - p, 2)) / nullif(var_pop(a) * count(*), 0)')} AS r2 FROM e GROUP BY o_orderstatus""",
    }
    # The same results by the ways that large tables take.
    found["grown_tree_handover"] = found["grown_tree"]
    found["scan_delimited"] = found["scan_normalised"]
    found["appended_fingerprint"] = found["dataset_fingerprint"]
    found["pipeline_summary_kept"] = found["pipeline_summary"]
    found["correlation_tiled"] = found["correlation_wide"]
    found["duplicate_rows_many"] = found["duplicate_rows"]
    found["text_unique_counts"] = union(
        f"SELECT '{name}' AS column_name, count(DISTINCT {value}) AS unique_count FROM documents"
        for name, value in (("text", "text"), ("lang", "lang"), ("source", "source"), ("length", "n_chars"))
    )
    found |= {
        f"{name}_narrowed": found[name]
        for name in ("outlier_summary", "curvature_binned", "stratified_split", "median_impute")
    }
    return found
