"""Daily-log flow: clean -> prepare -> fit -> transform -> split -> train (pipeline B).

A daily log ``(store, date, sales, open, promo, ...)``, a store table and a
store -> state table become one prepared table:

* clean: snake_case renames (P1), '' for categoricals (N1), median distance (N2);
* prepare: competition / promo start in epoch days with median fill (F10, F11),
  date parts as strings (F9), store left join (J1, J2), promo-interval month
  flag (R4, R5), per-store mean target attached to rows (J9, computed before
  the open/sales filter), filter ``open = '1' and sales > 0`` (P5);
* fit: mean / sample std / median per numeric and the store -> mean table
  (A7, A8, S7); transform: ``log1p`` target (F12) and '' refill (N1);
* split: last 30 % of each store's days (W2); train: ridge (M1), predict with
  closed days -> 0 (M13).  Serving reuses the saved store table and the saved
  store -> mean table (J10).

``train`` runs them in an order without leaks: the open days are split first, and store means, statistics
and model see the training part alone.  Its ``SalesState`` holds all that serving needs; ``save`` and ``load``
keep it as one versioned bundle, and ``predict`` serves new records, in a batch or a stream alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelane.functions.arrays import interval_flag
from featurelane.functions.dates import date_parts, log1p_target, year_month_days, year_week_days
from featurelane.operators.clean import camel_to_snake, column_quantiles, feature_columns, fill_median, filter_equals, project
from featurelane.operators.joins import join_dim, lookup_stats
from featurelane.operators.split import chrono_split
from featurelane.session import cut_lineage
from featurelane.sources.bundle import open_bundle, save_bundle

# The prepared table's columns in order, with the default of a missing value.
HEADER: dict[str, object] = {
    "store": 0, "day_of_week": "", "open": "", "promo2": "", "promo": "", "state_holiday": "", "school_holiday": "",
    "store_type": "", "assortment": "", "state": "", "year": "", "month": "", "day": "", "sales_mean": 0.0,
    "competition_distance": 0.0, "competition_open_since": 0.0, "competition_open_since_month": "",
    "competition_open_since_year": "", "promo2since": 0.0, "promo2since_week": "", "promo2since_year": "", "sales": 0.0}
# The feature crosses of the wide part.
CROSSES: dict[str, list[str]] = {
    "promo_datetime_cross": ["promo", "promo2", "year", "month", "day", "day_of_week"],
    "promo_holiday_cross": ["promo", "promo2", "state", "state_holiday", "school_holiday"],
    "store_type_cross": ["state", "store_type", "assortment", "day_of_week"],
    "competition_cross": ["competition_open_since_month", "competition_open_since_year"]}
NUMERIC = ["competition_distance", "competition_open_since", "promo2since", "sales_mean"]
CATEGORICAL = ["store_type", "assortment", "promo", "promo2", "day_of_week", "month", "state"]


@dataclass
class SalesSpec:
    store: str = "store"
    date: str = "date"
    target: str = "sales"
    open_col: str = "open"
    categorical: list[str] = field(default_factory=lambda: ["day_of_week", "open", "promo", "state_holiday",
                                                            "school_holiday"])
    numeric: list[str] = field(default_factory=lambda: ["competition_distance", "competition_open_since",
                                                        "promo2since", "sales_mean"])
    valid: float = 0.3
    use_week: bool = True


def clean(log: DataFrame, store: DataFrame, states: DataFrame, spec: SalesSpec):
    """P1 + N1 + N2."""
    ren = lambda df: df.withColumnsRenamed({c: camel_to_snake(c) for c in df.columns})
    log, store, states = ren(log), ren(store), ren(states)
    log = log.na.fill("", [c for c in spec.categorical if c in log.columns] + [spec.date])
    store = fill_median(store, ["competition_distance"])
    return log, store, states


def prepare_store(store: DataFrame, states: DataFrame, spec: SalesSpec) -> DataFrame:
    """F10/F11 with median fill, '' for the raw parts, state join."""
    s = store.withColumn("competition_open_since",
                         year_month_days("competition_open_since_year", "competition_open_since_month").cast("double"))
    s = s.withColumn("promo2since", year_week_days("promo2since_year", "promo2since_week",
                                                   add_week=spec.use_week).cast("double"))
    s = fill_median(s, ["competition_open_since", "promo2since"])
    s = s.na.fill("", ["competition_open_since_year", "competition_open_since_month",
                       "promo2since_year", "promo2since_week"])
    return cut_lineage(s.join(states, spec.store, "left"))  # stage end (small store table)


def fit(prepared: DataFrame, spec: SalesSpec) -> tuple[dict, DataFrame]:
    """``{feature: {mean, stdv, median}}`` and the store -> mean table."""
    cols = [c for c in spec.numeric if c in prepared.columns]
    row = prepared.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]).first()
    med = column_quantiles(prepared, cols)
    stats = {c: {"mean": row[f"m_{c}"], "stdv": row[f"s_{c}"], "median": med[c]} for c in cols}
    means = prepared.groupBy(spec.store).agg(F.avg(spec.target).alias("sales_mean"))
    return stats, means


def split(prepared: DataFrame, spec: SalesSpec, dates_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """W2 per store by date; with ``dates_path`` the (store, date, split) series
    is also written as JSON for the actual-vs-predicted view (S6)."""
    from featurelane.sources.io import write_series
    s = cut_lineage(chrono_split(prepared, spec.store, [spec.date], valid=spec.valid))  # stage end
    if dates_path:
        write_series(s, dates_path, [spec.store, spec.date, "split"])
    return s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "valid").drop("split")


def standardize(df: DataFrame, stats: dict | None) -> DataFrame:
    """``(x - mean) / stdv`` per feature with its own statistics; none if no stats."""
    if not stats:
        return df
    out = df
    for c, s in stats.items():
        if c in df.columns and s.get("stdv"):
            out = out.withColumn(c, (F.col(c) - F.lit(s["mean"])) / F.lit(s["stdv"]))
    return out


# ------------------------------------------------- training and serving over one saved state

def attach(log: DataFrame, store: DataFrame, means: DataFrame, spec: SalesSpec, target: bool) -> DataFrame:
    """The declared header (with the date in front) of training or new records."""
    df = log.select("*", *date_parts(F.col(spec.date).try_cast("date")))
    df = join_dim(df, store, spec.store)
    df = df.withColumn("promo2", interval_flag("promo2", "month", "promo_interval"))
    df = lookup_stats(df, means, [spec.store])
    names = [c for c in HEADER if target or c != spec.target]
    return project(df, names, {spec.date: spec.date}).na.fill({c: HEADER[c] for c in names if c != spec.store})


@dataclass
class SalesState:
    """Fitted state of the flow: store table, store -> mean table, statistics, model."""

    spec: SalesSpec
    store: DataFrame
    means: DataFrame
    stats: dict
    model: PipelineModel
    version: int | None = None

    def save(self, spark: SparkSession, base: str) -> int:
        """Write the next version below ``base``."""
        return save_bundle(spark, base, {"store": self.store, "sales_mean": self.means},
                           {"spec": asdict(self.spec), "feature_stats": self.stats}, {"model": self.model})

    @classmethod
    def load(cls, spark: SparkSession, base: str, version: int | None = None) -> "SalesState":
        b = open_bundle(spark, base, version)
        return cls(SalesSpec(**b.doc("spec")), b.frame("store"), b.frame("sales_mean"), b.doc("feature_stats"), b.model("model"), b.version)

    def features(self, records: DataFrame) -> DataFrame:
        """New records (either naming) as the scaled header, without a target."""
        named = records.withColumnsRenamed({c: camel_to_snake(c) for c in records.columns})
        named = named.na.fill("", [c for c in [*self.spec.categorical, self.spec.date] if c in named.columns])
        return standardize(attach(named.drop(self.spec.target), self.store, self.means, self.spec, target=False), self.stats)

    def predict(self, records: DataFrame, name: str = "pred") -> DataFrame:
        """Every record with its predicted sales; 0 on days that are not open."""
        from featurelane.plans.models import predict_sales
        return predict_sales(self.model, self.features(records), self.spec.open_col, name)


def train(log: DataFrame, store: DataFrame, states: DataFrame, spec: SalesSpec, numeric: Sequence[str] = NUMERIC,
          categorical: Sequence[str] = CATEGORICAL, alpha: float = 0.5, dates_path: str | None = None) -> tuple[SalesState, DataFrame, DataFrame]:
    """The fitted state, and the prepared and scaled training and validation parts (target on the log scale)."""
    from featurelane.plans.models import ridge
    log, store, states = clean(log, store, states, spec)
    store_p = prepare_store(store, states, spec)
    open_days = filter_equals(log, spec.open_col, "1").where(F.col(spec.target) > 0)
    first, last = split(open_days, spec, dates_path)
    means = cut_lineage(first.groupBy(spec.store).agg(F.avg(spec.target).alias("sales_mean")))
    # staged before the statistics, whose passes then read the numbers alone; scaling is a projection
    parts = [cut_lineage(attach(p, store_p, means, spec, target=True).withColumn(spec.target, log1p_target(spec.target))) for p in (first, last)]
    stats = fit(parts[0], spec)[0]
    parts = [standardize(p, stats) for p in parts]
    known = set(feature_columns(parts[0], spec.target, [spec.date]))
    if not known.issuperset([*numeric, *categorical]):
        raise ValueError(f"not features of the prepared table: {sorted({*numeric, *categorical} - known)}")
    state = SalesState(spec, store_p, means, stats, ridge(parts[0], spec.target, numeric, categorical, alpha, parts[0].unionByName(parts[1])))
    return state, *parts


def crosses(prepared: DataFrame, buckets: int = 10000) -> DataFrame:
    """The four hashed crosses of the prepared table's columns."""
    from featurelane.operators.encoders import hashed_cross
    return prepared.select("*", *[hashed_cross(cols, buckets).alias(name) for name, cols in CROSSES.items()])
