"""A whole batch run: scan -> file verdict -> clean -> checks -> enrich ->
checks -> gate -> keyed rows, with per-file reports and a run summary computed
from the same plan, and `run_batch`, which writes all of it.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import schema as S
from tallyline.functions import null_tokens
from tallyline.operators import validate as V
from tallyline.operators.clean import REJECT_REASON, CleanConfig, CleanOutput, clean, from_classified
from tallyline.operators.enrich import EnrichConfig, enrich, enrichment_stats
from tallyline.operators.table import (
    DEFAULT_BUCKETS,
    GATE_REASON,
    KeyedSalesTable,
    LoadResult,
    latest_accepted,
    latest_order,
    load_gate,
)
from tallyline.session import keep, remove
from tallyline.sources.archive import archive_rows
from tallyline.sources.csv_files import list_csv_files, read_sales_csv


@dataclass(frozen=True)
class RunConfig:
    clean: CleanConfig = field(default_factory=CleanConfig)
    enrich: EnrichConfig = field(default_factory=EnrichConfig)
    run_id: str = "manual"
    strict: bool = False
    on_fail: str = "warn"   # warn | drop | fail: what a failed post-clean check does


def normalize_nulls(raw: DataFrame) -> DataFrame:
    """CSV missing-value tokens to null on the data columns (lineage untouched)."""
    return raw.select(
        *[null_tokens(F.col(c)).alias(c) if c in S.REQUIRED_COLUMNS else F.col(c) for c in raw.columns]
    )


@dataclass
class BatchRun:
    cfg: RunConfig
    raw: DataFrame
    profile: DataFrame      # per file: verdict + raw warnings (one aggregate)
    verdict: DataFrame
    valid_raw: DataFrame
    cleaning: CleanOutput
    enriched: DataFrame
    gated: DataFrame
    kept: list[str] = field(default_factory=list)

    @property
    def cleaned(self) -> DataFrame:
        return self.cleaning.cleaned

    def loaded(self) -> DataFrame:
        """Accepted rows, the last row of the last file wins per order_id: the table after the run."""
        return latest_accepted(self.gated, latest_order(self.gated) or [F.col(S.SOURCE_FILE).desc()]).select(*S.TABLE_COLUMNS)

    def rejected(self) -> DataFrame:
        return self.gated.where(F.col(GATE_REASON).isNotNull())

    def quarantine(self) -> DataFrame:
        """Every row that is not loaded for a fault, as text, with the stage and
        the reason: rows of refused files, rows that do not parse or are out of
        range, rows that break a table constraint."""
        text = [F.col(c).cast("string").alias(c) for c in S.REQUIRED_COLUMNS]

        def of(df, stage, reason):
            return df.select(S.SOURCE_FILE, *text, F.lit(stage).alias("stage"), reason.alias("reason"))

        refused = self.verdict.where(~F.col("is_valid")).select(S.SOURCE_FILE, F.when(
            F.col("missing_columns") != "", F.concat(F.lit("missing_columns:"), F.col("missing_columns"))).when(
            F.col("malformed_rows") > 0, "malformed_rows").otherwise("null_order_ids").alias("_why"))
        return (of(self.raw.join(refused, S.SOURCE_FILE), "file", F.col("_why"))
                .unionByName(of(self.cleaning.rejected, "clean", F.col(REJECT_REASON)))
                .unionByName(of(self.rejected(), "load", F.col(GATE_REASON))))

    def cleaning_stats(self) -> DataFrame:
        return self.cleaning.stats()

    def reports(self) -> DataFrame:
        """Validation report rows for the raw, cleaned and enriched stages, per file.

        Cleaned and enriched rows are the same rows, so one aggregate over the
        enriched rows gives both stages' rule counts, the row counts and the
        quality figures; the raw stage comes from the file profile and the
        data-loss figure from the cleaning statistics."""
        keys = [S.SOURCE_FILE]
        data = [c for c in self.cleaned.columns if c != S.ROW_ORDINAL]
        edata = [c for c in self.enriched.columns if c != S.ROW_ORDINAL]
        enriched = self.enriched.select(*edata)
        long, wide = V.stage_counts(enriched, ["cleaned", "enriched"], V.quality_aggregates())
        stats = self.cleaning_stats()
        # From the cleaning figures on: a file that lost all its rows has a report too.
        sizes = stats.select(*keys).join(wide.select(*keys, "total_rows"), keys, "left").fillna(0, ["total_rows"])
        q = V.quality_from_aggregates(wide.withColumnRenamed("total_rows", "cleaned_count"), stats, keys)
        clean_w = V.quality_warning_texts(q, keys)
        strict = self.cfg.strict
        cleaned_problems = V.schema_problems(self.cleaned.select(*data), "cleaned")
        enriched_problems = V.schema_problems(enriched, "enriched")
        return (
            V.raw_stage_report(self.profile, strict)
            .unionByName(V.report_from_counts(long, sizes, "cleaned", keys, clean_w, cleaned_problems, strict))
            .unionByName(V.report_from_counts(long, sizes, "enriched", keys, None, enriched_problems, strict))
        )

    def materialize(self) -> "BatchRun":
        """The classified rows (deduped, tagged) written to the shared checkpoint
        folder, so the several reports of a run read them instead of
        recomputing scan, joins and dedupe each time."""
        classified, path = keep(self.cleaning.classified, "run-classified")
        self.kept.append(path)
        return _assemble(self.cfg, self.raw, self.profile, self.verdict, self.valid_raw, classified, self.kept)

    def discard(self) -> None:
        """Remove what the run wrote to the checkpoint folder, once its results are taken."""
        while self.kept:
            remove(self.raw.sparkSession, self.kept.pop())

    def file_report(self) -> DataFrame:
        """Per valid file: counts through the stages, revenue and cleaning figures."""
        es = enrichment_stats(self.enriched, self.cfg.enrich).select(
            S.SOURCE_FILE, F.col("row_count").alias("enriched_count"), "total_revenue"
        )
        cs = self.cleaning_stats()
        return cs.join(es, S.SOURCE_FILE, "left").select(
            S.SOURCE_FILE,
            "original_count",
            "cleaned_count",
            F.coalesce(F.col("enriched_count"), F.lit(0)).cast("long").alias("enriched_count"),
            F.coalesce(F.col("total_revenue"), F.lit(0.0)).alias("total_revenue"),
            "duplicates_removed",
            "invalid_dates_removed",
            "invalid_numerics_removed",
            "removal_rate",
        )

    def summary(self, archived: DataFrame | None = None) -> DataFrame:
        """One row: files detected / valid / invalid, rows loaded / failed, files
        archived, status. Built from per-file figures joined on the file name;
        ``archived`` holds the files that the archive really has."""
        per_file = self.gated.groupBy(S.SOURCE_FILE).agg(
            F.count_if(F.col(GATE_REASON).isNull()).alias("ok_rows"),
            F.count_if(F.col(GATE_REASON).isNotNull()).alias("bad_rows"),
        )
        files = self.verdict.select(S.SOURCE_FILE, "is_valid").join(per_file, S.SOURCE_FILE, "left")
        if archived is None:
            files = files.withColumn("_archived", F.lit(False))
        else:
            files = files.join(archived.select(S.SOURCE_FILE, F.lit(True).alias("_archived")).distinct(), S.SOURCE_FILE, "left")
        failed = F.coalesce(F.sum("bad_rows"), F.lit(0)).cast("long")
        return files.agg(
            F.lit(self.cfg.run_id).alias("run_id"),
            F.count(F.lit(1)).alias("files_detected"),
            F.count_if(F.col("is_valid")).alias("files_valid"),
            F.count_if(~F.col("is_valid")).alias("files_invalid"),
            F.coalesce(F.sum("ok_rows"), F.lit(0)).cast("long").alias("rows_loaded"),
            failed.alias("rows_failed"),
            F.count_if(F.coalesce("_archived", F.lit(False))).alias("files_archived"),
            F.when(failed == 0, F.lit("SUCCESS")).otherwise(F.lit("PARTIAL_SUCCESS")).alias("status"),
        )


def _valid(raw: DataFrame, profile: DataFrame):
    """Rows of valid files, without the scan's helper columns. The profile is a
    written table of a row per file, so Spark knows its size and picks the join."""
    verdict = profile.select(S.SOURCE_FILE, *V.VERDICT_COLUMNS)
    good = profile.where(F.col("is_valid")).select(S.SOURCE_FILE)
    helpers = [c for c in raw.columns if c.startswith("_")]
    return verdict, raw.drop(*helpers).join(good, S.SOURCE_FILE, "left_semi")


def _classify(valid_raw: DataFrame, cfg: RunConfig) -> DataFrame:
    return clean(valid_raw, cfg.clean).classified


def _assemble(cfg: RunConfig, raw, profile, verdict, valid_raw, classified, kept) -> BatchRun:
    cleaning = from_classified(classified, valid_raw, cfg.clean)
    cleaned = cleaning.cleaned
    if cfg.on_fail == "drop":
        # Rows breaking a cleaned-stage rule are removed instead of only reported.
        bad = F.lit(False)
        for r in V.CLEANED_RULES:
            if not r.group:
                bad = bad | r.fails()
        cleaned = cleaned.where(~bad)
        cleaning = CleanOutput(cleaned, cleaning.rejected, cleaning.classified, cleaning.raw)
    enriched = enrich(cleaned, cfg.enrich)
    gated = load_gate(enriched, cfg.enrich.run_ts)
    return BatchRun(cfg, raw, profile, verdict, valid_raw, cleaning, enriched, gated, kept)


def plan_run(raw: DataFrame, cfg: RunConfig = RunConfig(), header_columns: DataFrame | None = None,
             materialize: bool = False) -> BatchRun:
    """Lazy after the file verdict unless ``materialize``; the caller decides
    what to write or count."""
    raw = normalize_nulls(raw)
    kept = []
    if materialize:
        # the verdict, the rows, the archive and the quarantine all read the raw rows: they are computed once
        raw, raw_path = keep(raw, "run-raw")
        kept.append(raw_path)
    # The file verdict is a barrier, as in any file-by-file load: one small
    # aggregate (a row per file) is computed and kept before the rows flow.
    profile, path = keep(V.raw_profile(raw, header_columns), "run-profile")
    verdict, valid_raw = _valid(raw, profile)
    run = _assemble(cfg, raw, profile, verdict, valid_raw, _classify(valid_raw, cfg), [*kept, path])
    run = run.materialize() if materialize else run
    if cfg.on_fail == "fail":
        data = [c for c in run.cleaned.columns if c != S.ROW_ORDINAL]
        bad = V.rule_counts(run.cleaned.select(*data), "cleaned", keep_zero=False)
        shown = bad.orderBy(*bad.columns).limit(10).collect()       # the message names ten
        if shown:
            raise ValueError("post-clean checks failed: " + ", ".join(
                f"{r[S.SOURCE_FILE]}:{r['column']}:{r['check']}={r['failures']}" for r in shown))
    return run


@dataclass
class RunPaths:
    table: str          # keyed sales table
    archive: str        # raw rows of loaded files
    quarantine: str     # rows that were not loaded, with reason
    reports: str        # stage reports, file reports and run summaries


def execute(rows: DataFrame, headers: DataFrame, paths: RunPaths, cfg: RunConfig = RunConfig(),
            buckets: int = DEFAULT_BUCKETS) -> LoadResult:
    """A whole run: check, clean, enrich, load, archive, quarantine, report.

    The rows are evaluated once (the classified rows are kept) and every output
    goes to the run's own folder, ``run_id=<id>``, which is written anew: a run
    repeated after a failure changes nothing, as an upsert applied twice equals
    one."""
    spark, run_id, mine = rows.sparkSession, cfg.run_id, f"run_id={cfg.run_id}"
    began = time.monotonic()
    run = plan_run(rows, cfg, headers, materialize=True)
    checked = time.monotonic() - began
    result = KeyedSalesTable(spark, paths.table, buckets).upsert(run.enriched, run_ts=cfg.enrich.run_ts)
    on = cfg.enrich.run_ts.date() if cfg.enrich.run_ts else None
    archive_rows(run.valid_raw, paths.archive, run_id, on)
    done = run.verdict.where("is_valid").select(S.SOURCE_FILE).join(
        spark.read.parquet(f"{paths.archive}/{mine}").select(S.SOURCE_FILE).distinct(), S.SOURCE_FILE, "left_semi")
    run.quarantine().write.mode("overwrite").parquet(f"{paths.quarantine}/{mine}")
    # the stages are checked in one pass over all files, so they share its duration
    (run.reports().withColumns({"duration_seconds": F.lit(round(checked, 4)), "metadata": F.to_json(F.struct(
        F.col(S.SOURCE_FILE).alias("file_name"), F.lit(run_id).alias("run_id"), F.col("total_rows")))})
     .write.mode("overwrite").parquet(f"{paths.reports}/stages/{mine}"))
    run.file_report().write.mode("overwrite").parquet(f"{paths.reports}/files/{mine}")
    (run.summary(done).drop("run_id").withColumns({"rows_inserted": F.lit(result.rows_inserted), "rows_updated": F.lit(result.rows_updated)})
     .write.mode("overwrite").parquet(f"{paths.reports}/runs/{mine}"))
    run.discard()
    return result


def run_batch(spark: SparkSession, incoming: str | list[str], paths: RunPaths, cfg: RunConfig = RunConfig(),
              buckets: int = DEFAULT_BUCKETS, multi_line: bool = False) -> LoadResult:
    """Run over all CSV files of a folder (or of listed paths, see ``escape_path``).

    Without any file the run stops at once: nothing is written, and the result counts nothing."""
    if list_csv_files(spark, incoming).isEmpty():
        return LoadResult(True, 0, 0, 0)
    rows, headers = read_sales_csv(spark, incoming, multi_line)
    return execute(rows, headers, paths, cfg, buckets)
