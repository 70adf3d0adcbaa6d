"""Derived features.

Row-local features are plain projections. Features that need training statistics are
fitted on the training rows first and then applied as literals, so applying them is a
projection as well and cannot leak information from other rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.expressions import ratio
from plumbline.functions.moments import is_constant
from plumbline.functions.quantiles import BOUNDED_GROUP, fit_quantiles
from plumbline.schema import Ratio, quoted, require_columns

EARTH_RADIUS_KM = 6371.0088
UNMAPPED = "OTHER"
BROADCAST_ROWS = 1_000_000


def ratio_features(df: DataFrame, ratios: Sequence[Ratio]) -> DataFrame:
    """Add each ratio whose two source columns exist; a zero denominator gives NULL."""
    made = {
        r.name: ratio(quoted(r.numerator), quoted(r.denominator))
        for r in ratios
        if r.numerator in df.columns and r.denominator in df.columns
    }
    return df.withColumns(made) if made else df


def ratio_audit(df: DataFrame, ratios: Sequence[Ratio]) -> DataFrame:
    """Zero and missing denominators of each ratio, from one aggregation."""
    rows = [
        F.struct(
            F.lit(r.name).alias("feature_name"),
            F.lit(r.denominator).alias("denominator"),
            F.count_if(quoted(r.denominator) == 0).alias("zero_denominators"),
            F.count_if(quoted(r.denominator).isNull()).alias("missing_denominators"),
        )
        for r in ratios
    ]
    zero = F.col("zero_denominators")
    return df.agg(F.array(*rows).alias("all")).select(F.inline("all")).withColumn(
        "note",
        F.when(zero == 0, "No zero denominators detected in training data.").otherwise(
            F.concat(zero.cast("string"), F.lit(" zero denominator(s) detected in training data."))
        ),
    )


def interaction_features(
    df: DataFrame,
    products: Mapping[str, tuple[str, str]],
    by_level: Mapping[str, tuple[str, str, Sequence[str]]] | None = None,
) -> DataFrame:
    """Products of two columns, and a column switched on by each level of a category."""
    made = {n: quoted(a).cast("double") * quoted(b).cast("double") for n, (a, b) in products.items()}
    for name, (number, category, levels) in (by_level or {}).items():
        for level in levels:
            value = F.when(quoted(category) == F.lit(level), quoted(number).cast("double"))
            made[f"{name}_{level}"] = value.otherwise(F.lit(0.0))
    return df.withColumns(made)


def squared_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``name_squared`` for each column."""
    return df.withColumns(
        {f"{n}_squared": quoted(n).cast("double") * quoted(n).cast("double") for n in columns}
    )


def fit_moments(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each training column; exact for a constant one."""
    cells = []
    for n in columns:
        c = quoted(n).cast("double")
        same = is_constant(c)
        cells.append(
            F.struct(
                F.when(same, F.min(c)).otherwise(F.avg(c)).alias("mean"),
                F.when(same, F.lit(0.0)).otherwise(F.stddev_pop(c)).alias("deviation"),
            )
        )
    found = train.agg(F.array(*cells).alias("all")).first()["all"]
    return {n: (cell["mean"], cell["deviation"]) for n, cell in zip(columns, found)}


def _centred(name: str, mean: float | None) -> Column:
    return quoted(name).cast("double") - F.lit(mean).cast("double")


def _standard(name: str, moments: tuple[float | None, float | None]) -> Column:
    mean, spread = moments
    # A constant column scales to 0.
    return _centred(name, mean) / F.lit(spread if spread else 1.0)


def centered_features(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``name_centered``: distance from the training mean."""
    moments = fit_moments(train, columns)
    return df.withColumns({f"{n}_centered": _centred(n, moments[n][0]) for n in columns})


def standardized_features(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``name_standardized``: training mean 0 and population deviation 1."""
    moments = fit_moments(train, columns)
    return df.withColumns({f"{n}_standardized": _standard(n, moments[n]) for n in columns})


def polynomial_features(df: DataFrame, columns: Sequence[str], degree: int = 2) -> DataFrame:
    """All products of the columns up to ``degree``, named like ``a^2`` and ``a*b``."""
    made: dict[str, Column] = {}
    terms: list[tuple[tuple[int, ...], Column]] = [((), F.lit(1.0))]
    for _ in range(degree):
        longer = []
        for picked, value in terms:
            for i in range(picked[-1] if picked else 0, len(columns)):
                longer.append(((*picked, i), value * quoted(columns[i]).cast("double")))
        terms = longer
        for picked, value in terms:
            if len(picked) > 1:
                made[_term_name([columns[i] for i in picked])] = value
    return df.withColumns(made)


def _term_name(names: Sequence[str]) -> str:
    parts = []
    for name in dict.fromkeys(names):
        power = list(names).count(name)
        parts.append(name if power == 1 else f"{name}^{power}")
    return "*".join(parts)


def spline_features(
    df: DataFrame,
    train: DataFrame,
    columns: Sequence[str],
    knots: Sequence[float] = (0.05, 0.35, 0.65, 0.95),
    bounded: int = BOUNDED_GROUP,
) -> DataFrame:
    """Restricted cubic spline basis with knots at training quantiles.

    ``name_spline_1`` ... are linear beyond the outer knots, scaled by the squared
    knot range. A column whose knots are not distinct gets no basis.
    """
    places = fit_quantiles(train, columns, list(knots), bounded=bounded)
    made: dict[str, Column] = {}
    for name in columns:
        t = places[name]
        if None in t or len(set(t)) < len(t):
            continue
        x = quoted(name).cast("double")

        def cube(knot: float, x: Column = x) -> Column:
            above = F.greatest(x - F.lit(knot), F.lit(0.0))
            # greatest() skips NULL, so a missing value must stay missing explicitly.
            return F.when(x.isNotNull(), above * above * above)

        last, before = t[-1], t[-2]
        scale = (last - t[0]) ** 2
        for j, knot in enumerate(t[:-2], start=1):
            term = (
                cube(knot)
                - cube(before) * F.lit((last - knot) / (last - before))
                + cube(last) * F.lit((before - knot) / (last - before))
            )
            made[f"{name}_spline_{j}"] = term / F.lit(scale)
    return df.withColumns(made) if made else df


def orthogonal_poly(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """First and second orthogonal polynomial of each column over the training rows.

    The second is ``(x-m)^2 - b (x-m) - c`` with b and c chosen so that it is
    uncorrelated with the first and has mean 0 on the training rows.
    """
    moments = fit_moments(train, columns)
    sums = []
    for i, n in enumerate(columns):
        d = _centred(n, moments[n][0])
        sums += [F.avg(d * d).alias(f"q{i}"), F.avg(d * d * d).alias(f"t{i}")]
    row = train.agg(*sums).first()
    made: dict[str, Column] = {}
    for i, n in enumerate(columns):
        second, third = row[f"q{i}"], row[f"t{i}"]
        d = _centred(n, moments[n][0])
        slope = third / second if second else 0.0
        made[f"{n}_poly_1"] = d
        made[f"{n}_poly_2"] = d * d - F.lit(slope) * d - F.lit(second).cast("double")
    return df.withColumns(made)


def category_groups(
    df: DataFrame, column: str, mapping: DataFrame, output: str, default: str = UNMAPPED
) -> DataFrame:
    """Replace levels by approved groups from a ``level, group_name`` table.

    Unlisted levels and NULL get ``default``. The mapping is broadcast only after its
    size was checked; a larger one is joined by shuffle.
    """
    require_columns(mapping, ["level", "group_name"], "category grouping")
    side = mapping.select(F.col("level").alias("_level"), F.col("group_name").alias("_group"))
    if side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        side = F.broadcast(side)
    joined = df.join(side, quoted(column) == F.col("_level"), "left")
    return joined.withColumn(output, F.coalesce("_group", F.lit(default))).drop("_level", "_group")


def haversine_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    inner = half_lat * half_lat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(inner, F.lit(1.0))))


def nearest_distance(
    df: DataFrame,
    latitude: str,
    longitude: str,
    points: Sequence[tuple[float, float]],
    output: str = "nearest_distance_km",
) -> DataFrame:
    """Distance to the nearest reference point (latitude, longitude).

    The caller names a short list of points, so the minimum is an expression over
    literals: a projection, no join.
    """
    if not points:
        raise ValueError("At least one reference point is needed.")
    lat, lon = quoted(latitude).cast("double"), quoted(longitude).cast("double")
    distances = [haversine_km(lat, lon, F.lit(float(a)), F.lit(float(b))) for a, b in points]
    nearest = distances[0] if len(distances) == 1 else F.least(*distances)
    # least() skips NULL, so a row without a place must be excluded explicitly.
    return df.withColumn(output, F.when(lat.isNotNull() & lon.isNotNull(), nearest))


def composite_index(
    df: DataFrame, train: DataFrame, weights: Mapping[str, float], output: str = "composite_index"
) -> DataFrame:
    """Weighted sum of training-standardised columns; NULL if any part is missing."""
    moments = fit_moments(train, list(weights))
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + F.lit(float(weight)) * _standard(name, moments[name])
    return df.withColumn(output, total)
