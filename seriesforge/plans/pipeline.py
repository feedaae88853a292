"""The end-to-end flow: collect -> features -> train/register -> predict,
plus the profile report. Every stage reads the latest version of its inputs
and writes a new version folder (``<stage>/v=<n>``), so a failed or retried
stage never leaves a half-written table behind, and lineage is cut at each
stage boundary by the written table itself.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.operators import evaluate as EV
from seriesforge.operators import features as FE
from seriesforge.operators import forecast as FC
from seriesforge.operators import ingest as IN
from seriesforge.operators import profile as PR
from seriesforge.operators import quality as QU
from seriesforge.operators.joins import join_exogenous
from seriesforge.functions.scalar import normalize_name_py
from seriesforge.sources import store
from seriesforge.sources.files import write_documents, write_table
from seriesforge.sources.store import read_latest, write_version
from seriesforge.spec import SeriesSpec


@dataclass
class Pipeline:
    """Folders under ``root`` (shared storage on a cluster). The raw table is
    one month-partitioned folder updated partition by partition; the derived
    tables are written as new version folders."""
    root: str
    spec: SeriesSpec = field(default_factory=lambda: SeriesSpec(("series_id",), "date", "y"))
    wide_values: list[str] = field(default_factory=lambda: list(IN.WIDE_COLUMNS))
    target: str = "corrigido_temperatura"
    exog_variables: list[str] = field(default_factory=list)
    default_start: str = "2010-01-01"

    def path(self, name: str) -> str:
        return store.join(self.root, name)

    # ------------------------------------------------------------- collect
    def collect(self, spark: SparkSession, row_payloads: DataFrame | None = None,
                columnar_payloads: DataFrame | None = None, end_date: str | None = None) -> dict:
        """I1-I3 + S3 + A1 + P1 + S6 + S4 + J1.

        ``row_payloads``: (series_id, date_query, ingest_seq, payload) JSON
        arrays of {type, daily_Accumulation}; ``columnar_payloads``:
        (payload) documents {"daily": {"time": [...], <var>: [...]}}.
        Rows on or before the stored high-water mark of their series are not
        landed again (the reference starts fetching the day after it)."""
        keys = self.spec.key_cols
        out = {}
        raw_path = self.path("raw")
        raw_old = spark.read.parquet(raw_path) if store.exists(spark, raw_path) else None
        if row_payloads is not None:
            land = IN.land_row_json(row_payloads, "date_query", "payload", "ingest_seq", keep=keys)
            land = land.select(*keys, "date_query", "type", "daily_accumulation", "ingest_seq")
            if raw_old is None:
                # P1/P2/U3 before any write: nothing is stored without the target
                IN.require_values(land, self.wide_values, [self.target])
            # Only days after the stored mark of each series (2 columns read)
            land = IN.new_rows(land, raw_old, "date_query", keys, self.default_start, end_date)
            # Month partitions touched by the delta are rewritten, the rest stay
            out["raw_months"] = IN.upsert_partitions(spark, raw_path, land, [*keys, "date_query", "type"],
                                                     "ingest_seq")
            raw_old = spark.read.parquet(raw_path) if store.exists(spark, raw_path) else None
        if raw_old is not None:
            out["missing_columns"] = IN.require_values(raw_old, self.wide_values, [self.target])
            wide = IN.pivot_wide(raw_old, self.wide_values, keys=keys)
            names = [normalize_name_py(v) for v in self.wide_values]  # F1, as in the pivot
            wide, _ = IN.select_available(wide, names, required=[normalize_name_py(self.target)],
                                          always=[*keys, "date"])
            out["wide"] = write_version(wide, self.path("wide"))
            write_table(FC.latest_row(read_latest(spark, self.path("wide")), self.spec), self.path("latest"))
        if columnar_payloads is not None:
            ex_new = IN.land_columnar_json(columnar_payloads, self.exog_variables).withColumn(
                "__seq", F.lit(1))
            ex_old = read_latest(spark, self.path("exog"))
            if ex_old is not None:
                ex_new = ex_old.withColumn("__seq", F.lit(0)).unionByName(ex_new)
            ex = IN.keep_last(ex_new.where(F.col("date").isNotNull()), ["date"], "__seq").drop("__seq")
            out["exog"] = write_version(ex, self.path("exog"))
        wide, ex = read_latest(spark, self.path("wide")), read_latest(spark, self.path("exog"))
        if wide is not None and ex is not None:
            out["base"] = write_version(join_exogenous(wide, ex), self.path("base"))
        return out

    def freshness(self, spark: SparkSession, as_of) -> DataFrame:
        """I4: is the last stored date of each landed table the day before
        ``as_of`` (reads only the date columns)."""
        stages = {}
        if store.exists(spark, self.path("raw")):
            stages["raw"] = spark.read.parquet(self.path("raw")).select(F.col("date_query").alias("date"))
        ex = read_latest(spark, self.path("exog"))
        if ex is not None:
            stages["exogenous"] = ex.select("date")
        return IN.freshness(stages, "date", as_of)

    # ------------------------------------------------------------ features
    def features(self, spark: SparkSession) -> dict:
        """Training table (targets, rows with all targets) and production
        table (every row), both written as new versions."""
        base = read_latest(spark, self.path("base"))
        spec = self.spec.with_value(normalize_name_py(self.target))
        return {"train": write_version(FE.build_features(base, spec, training=True), self.path("features_train")),
                "production": write_version(FE.build_features(base, spec, training=False),
                                            self.path("features_production"))}

    # ---------------------------------------------------------- train/predict
    def train(self, spark: SparkSession, cfg=None) -> dict:
        """M1-M6 + S8-S10: competition, candidate models, registry update."""
        from seriesforge.plans import train as TR
        spec = self.spec.with_value(normalize_name_py(self.target))
        ft = read_latest(spark, self.path("features_train"))
        res = TR.train_competition(ft, spec, cfg, out_dir=self.path("models"))
        res["decisions"] = TR.update_registry(spark, self.path("registry"), res["winners"], res["run_path"])
        return res

    def predict(self, spark: SparkSession, as_of=None) -> str:
        """M8 + J2 + J3 + S7 from what is stored alone: the last day of every
        series through the production models of the registry (with the
        preprocessing saved beside each), their own metrics, and the exogenous
        values of the forecast days; one JSON document per series."""
        from seriesforge.plans import train as TR
        spec = self.spec.with_value(normalize_name_py(self.target))
        fp = read_latest(spark, self.path("features_production"))
        reg = TR.read_registry(spark, self.path("registry"))
        fc = TR.score_production(fp, spec, reg, as_of)
        exog = read_latest(spark, self.path("exog"))
        fc = FC.attach_context(fc, reg.select("horizon", "rmse", "mae", "mape", "r2"), exog)
        last = FC.latest_row(fp.select(*spec.key_cols, spec.time, spec.value), spec).select(
            *spec.key_cols, F.col(spec.time).alias("last_date"), F.col(spec.value).cast("double").alias("last_value"))
        path = store.next_version(spark, self.path("forecast"))
        weather = [c for c in (exog.columns if exog is not None else []) if c != "date"]
        write_documents(FC.forecast_document(fc, last, spec.key_cols, weather_cols=weather, generated_at=F.current_timestamp()), path)
        return path

    # -------------------------------------------------------------- profile
    def profile(self, spark: SparkSession) -> dict:
        """The exploration report as tables."""
        base = read_latest(spark, self.path("base"))
        spec = self.spec.with_value(normalize_name_py(self.target))
        tables = {
            "null_report": QU.null_report(base, 20), "date_span": QU.date_span(base, spec),
            "completeness": QU.completeness(base, spec), "year_month": PR.year_month_pivot(base, spec),
            "yearly": PR.yearly_stats(base, spec), "monthly": PR.monthly_means(base, spec),
            "weekday": PR.weekday_profile(base, spec), "weekend": PR.weekend_effect(base, spec),
            "scalar": PR.scalar_profile(base, spec), "describe": PR.describe(base, spec),
            "iqr": PR.iqr_outliers(base, spec), "zscore": PR.zscore_outliers(base, spec),
            "shape": PR.shape(base, spec), "correlations": PR.target_correlations(base, spec),
            "histogram": PR.histogram(base, spec), "boxplot_month": PR.boxplot_stats(base, spec, True),
            "kde": PR.kde(base, spec), "qq": PR.qq_points(base, spec),
        }
        if self.exog_variables:
            tables["exog_trends"] = PR.exog_trends(base, spec, self.exog_variables)
        out = {}
        for name, df in tables.items():
            p = store.join(self.path("profile"), name)
            write_table(df, p)
            out[name] = p
        return out

    def summary(self, spark: SparkSession) -> DataFrame:
        """Per series the stored span and row count, with the number of
        production models and their mean RMSE from the registry (<= 7 rows,
        aggregated to one row that is joined)."""
        from seriesforge.plans import train as TR
        spec = self.spec.with_value(normalize_name_py(self.target))
        span = QU.date_span(read_latest(spark, self.path("base")), spec)
        reg = TR.read_registry(spark, self.path("registry")).agg(
            F.count(F.lit(1)).alias("n_models"), F.avg("rmse").alias("avg_rmse"))
        return QU.with_one_row(span, reg)

    def run_full(self, spark: SparkSession, row_payloads=None, columnar_payloads=None, cfg=None) -> dict:
        """collect -> features -> train -> predict (the daily batch)."""
        out = {"collect": self.collect(spark, row_payloads, columnar_payloads)}
        out["features"] = self.features(spark)
        res = self.train(spark, cfg)
        out["forecast"] = self.predict(spark)
        out["decisions"] = res["decisions"]
        return out
