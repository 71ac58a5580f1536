"""Cleaning: duplicates, missing values, text, dates, money checks and outliers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profitlens.config import DEFAULTS, Thresholds
from profitlens.functions.arithmetic import holds
from profitlens.functions.bitmap import Bitmap, divided
from profitlens.functions.dates import parsed_moment, whole_days
from profitlens.functions.ordered import quantiles
from profitlens.schema import CRITICAL_COLUMNS, OUTLIER_COLUMNS, TEXT_COLUMNS
from profitlens.session import stage
from profitlens.sources.csv import DATE_FORMATS

CHECK_COLUMNS = ("unit_price", "quantity", "discount_amount", "order_item_total")


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def row_digest(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes of the whole row; rows that are equal have equal ones."""
    # hashes pass over nulls, so where they stand is hashed too
    columns = [F.col(f"`{c}`") for c in df.columns]
    words = [F.lit(0).cast("bigint") for _ in range(0, len(columns), 63)]
    for i, c in enumerate(columns):
        words[i // 63] = words[i // 63] + F.when(c.isNull(), F.lit(1 << i % 63)).otherwise(F.lit(0))
    return F.xxhash64(*columns, *words), F.xxhash64(*words, *columns)


def counted_rows(df: DataFrame, digest: Callable[[DataFrame], tuple[Column, Column]] = row_digest) -> DataFrame:
    """Each distinct row once, with the number of its ``_copies``.

    A first pass shuffles digests alone and keeps those that occur twice. They
    form a bitmap: a row that it lacks has no copy and goes its way unshuffled,
    only the others are compared in full. A digest that two different rows
    share costs that comparison and nothing else. ``df`` is read twice; rows
    travel once, if at all.
    """
    first, second = digest(df)
    counts = df.select(first.alias("first"), second.alias("second")).groupBy("first", "second").agg(F.count("*").alias("n"))
    repeated = stage(counts.filter("n > 1").select("first"), "repeated_digests")
    n = repeated.count()
    if not n:
        return df.withColumn("_copies", F.lit(1).cast("bigint"))
    maybe, alone = divided(df, Bitmap.of(repeated, "first", n).may_hold(first))
    compared = maybe.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("_copies"))
    return alone.withColumn("_copies", F.lit(1).cast("bigint")).unionByName(compared)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Copies of a whole row are dropped."""
    return counted_rows(df).drop("_copies")


def drop_missing(df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    return df.dropna(subset=present(df, columns))


def normalise_text(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Trimmed upper case."""
    return df.withColumns({c: F.upper(F.trim(c)) for c in present(df, columns)})


def parse_dates(df: DataFrame, columns: Sequence[str], formats: tuple[str, ...] = DATE_FORMATS) -> DataFrame:
    """Text to timestamps; an unreadable date becomes null."""
    return df.withColumns({c: parsed_moment(F.col(c), formats) for c in present(df, columns)})


def money_adds_up(df: DataFrame, tolerance: float = DEFAULTS.financial_tolerance) -> Column:
    """Whether price * quantity - discount meets the total; true when it cannot be checked."""
    if len(present(df, CHECK_COLUMNS)) < len(CHECK_COLUMNS):
        return F.lit(True)
    expected = F.col("unit_price") * F.col("quantity") - F.col("discount_amount")
    return holds(F.abs(F.col("order_item_total") - expected) <= tolerance)


def tag_financials(df: DataFrame, tolerance: float = DEFAULTS.financial_tolerance) -> DataFrame:
    return df.withColumn("finval_ok", money_adds_up(df, tolerance))


def filter_financials(df: DataFrame, tolerance: float = DEFAULTS.financial_tolerance) -> DataFrame:
    return df.filter(money_adds_up(df, tolerance))


def nonnegative_sales(df: DataFrame) -> DataFrame:
    return df.filter(F.col("sales") >= 0)


def zscore_rule(df: DataFrame, columns: Sequence[str], limit: float) -> Column:
    """Whether all columns lie within ``limit`` population standard deviations of the mean.

    Unknown scores fail, and all rows do when a column has no spread. One
    aggregate brings back two numbers per column.
    """
    stats = df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns], *[F.stddev_pop(c).alias(f"dev_{c}") for c in columns]
    ).first()
    ok = F.lit(True)
    for c in columns:
        if not stats[f"dev_{c}"]:
            return F.lit(False)
        ok = ok & (F.abs((F.col(c) - stats[f"mean_{c}"]) / stats[f"dev_{c}"]) < limit)
    return holds(ok)


def iqr_rule(df: DataFrame, columns: Sequence[str], factor: float) -> Column:
    """Whether all columns lie within ``factor`` interquartile ranges of the quartiles."""
    ok = F.lit(True)
    for c, (low, high) in quantiles(df, columns, (0.25, 0.75)).items():
        if low is None:
            return F.lit(False)
        spread = (high - low) * factor
        ok = ok & F.col(c).between(low - spread, high + spread)
    return holds(ok)


def outlier_rule(df: DataFrame, settings: Thresholds = DEFAULTS) -> tuple[str, Column]:
    """The z-score rule, or the quartile rule when the former would remove too many rows."""
    columns = present(df, OUTLIER_COLUMNS)
    by_zscore = zscore_rule(df, columns, settings.zscore_limit)
    kept = df.agg(F.avg(by_zscore.cast("int"))).first()[0]
    if kept is not None and 1 - kept > settings.zscore_max_removed_share:
        return "IQR", iqr_rule(df, columns, settings.iqr_factor)
    return "Z-score", by_zscore


def outliers_zscore(df: DataFrame, limit: float = DEFAULTS.zscore_limit) -> DataFrame:
    return df.filter(zscore_rule(df, present(df, OUTLIER_COLUMNS), limit))


def outliers_iqr(df: DataFrame, factor: float = DEFAULTS.iqr_factor) -> DataFrame:
    return df.filter(iqr_rule(df, present(df, OUTLIER_COLUMNS), factor))


def outliers_adaptive(df: DataFrame, settings: Thresholds = DEFAULTS) -> DataFrame:
    return df.filter(outlier_rule(df, settings)[1])


def clean_with_report(df: DataFrame, settings: Thresholds = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """The clean rows, and one row that says how many rows each step took out.

    Later steps merely tag rows by a few columns. Those columns of the distinct
    rows are staged, and statistics and report scan them; whole rows are not
    copied, but read again where the result is written.
    """
    distinct = counted_rows(df)
    complete = F.lit(True)
    for c in present(df, CRITICAL_COLUMNS):
        complete = complete & F.col(c).isNotNull()
    adds_up = money_adds_up(df, settings.financial_tolerance)
    judged = dict.fromkeys([*present(df, CRITICAL_COLUMNS), *present(df, CHECK_COLUMNS), *present(df, OUTLIER_COLUMNS)])
    measures = stage(distinct.select(*judged, "_copies"), "measures")
    method, usual = outlier_rule(measures.filter(complete & adds_up), settings)
    report = measures.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("initial_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("initial_cols"),
        (F.coalesce(F.sum("_copies"), F.lit(0)) - F.count("*")).alias("dropped_duplicates"),
        F.count_if(~complete).alias("dropped_missing"),
        F.count_if(complete & ~adds_up).alias("financial_mismatches"),
        F.count_if(complete & adds_up & ~usual).alias("outliers_removed"),
        F.lit(method).alias("outlier_method"),
        F.count_if(complete & adds_up & usual).alias("final_rows"),
    )
    return normalise_text(distinct.filter(complete & adds_up & usual).drop("_copies")), report


def clean(df: DataFrame, settings: Thresholds = DEFAULTS) -> DataFrame:
    """All cleaning steps in order."""
    return clean_with_report(df, settings)[0]


def cleaning_report(df: DataFrame, settings: Thresholds = DEFAULTS) -> DataFrame:
    return clean_with_report(df, settings)[1]


# Margin bands, each including its upper bound.
MARGIN_BANDS = ((0.0, "Loss"), (0.10, "Thin (<10%)"), (0.25, "Healthy (10-25%)"))
TOP_MARGIN_BAND = "Star (>25%)"


def with_margin_band(df: DataFrame) -> DataFrame:
    band = F
    for upper, label in MARGIN_BANDS:
        band = band.when(F.col("profit_ratio") <= upper, label)
    return df.withColumn("margin_band", band.when(F.col("profit_ratio").isNotNull(), TOP_MARGIN_BAND))


def with_delivery_delay(df: DataFrame) -> DataFrame:
    """Full days from order to shipment; nothing is added without both dates."""
    if {"order_date", "ship_date"} <= set(df.columns):
        return df.withColumn("delivery_delay_days", whole_days(F.col("order_date"), F.col("ship_date")))
    return df


def with_delivery_overrun(df: DataFrame) -> DataFrame:
    """Days beyond the schedule, from the dates or else from the recorded shipping days."""
    delayed = with_delivery_delay(df)
    if "scheduled_days" not in df.columns:
        return delayed
    for days in ("delivery_delay_days", "real_days"):
        if days in delayed.columns:
            return delayed.withColumn(
                "delivery_overrun_days", (F.col(days) - F.col("scheduled_days")).cast("bigint")
            )
    return delayed
