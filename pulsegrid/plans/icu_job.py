"""The ICU batch job: contiguous slices, transform, unit alert rates, CSV sink.

The rows are split in admission order into N slices (``partition_id``). The
slices are only a column here: the transform is column arithmetic and runs on
all Spark partitions at once, instead of slice after slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.operators.prepare import preprocess_icu
from pulsegrid.operators.slices import contiguous_slices
from pulsegrid.session import remove_path, shared_scratch_path
from pulsegrid.sources import files
from pulsegrid.sources.releases import Releases

ICU_ORDER = ["admission_timestamp", "patient_id"]


def preprocess_icu_sliced(
    icu: DataFrame, n_slices: int = S.ICU_DEFAULT_SLICES, path: str | None = None
) -> DataFrame:
    """Slice id in admission order, then the ICU transform (16 + 6 columns).

    ``path`` is where the slice ranking is materialised (default: a fresh
    folder under the shared checkpoint folder).
    """
    sliced = contiguous_slices(icu, n_slices, ICU_ORDER, out_col="partition_id", path=path)
    return preprocess_icu(sliced).select(*S.ICU_PREPROCESSED_SCHEMA.fieldNames())


def icu_report(preprocessed: DataFrame, n_slices: int = S.ICU_DEFAULT_SLICES) -> dict[str, object]:
    """Rows per slice, alert rate per unit and the KPIs, from one aggregation pass.

    GROUPING SETS ((partition_id), (icu_unit), ()) computes all three in a single
    scan; the result has at most slices + units + 1 rows and is the only thing
    brought to the driver. Slices without rows are reported with 0.
    """
    summary = preprocessed.groupingSets(
        [["partition_id"], ["icu_unit"], []], "partition_id", "icu_unit"
    ).agg(
        F.grouping_id().alias("_gid"),
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.col("batch_alert").cast("double")).alias("alert_rate"),
        F.avg("mortality_risk").alias("avg_mortality_risk"),
    )
    rows = summary.collect()
    counted = {r["partition_id"]: r["rows"] for r in rows if r["_gid"] == 1}
    slice_rows = {k: counted.get(k, 0) for k in range(1, n_slices + 1)}
    units = sorted(
        ((r["icu_unit"], r["alert_rate"]) for r in rows if r["_gid"] == 2 and r["icu_unit"] is not None),
        key=lambda u: (-u[1], u[0]),
    )
    total = next((r for r in rows if r["_gid"] == 3), None)
    kpis = {
        "rows": total["rows"] if total else 0,
        "alert_rate": (total["alert_rate"] or 0.0) * 100 if total else 0.0,
        "avg_mortality_risk": (total["avg_mortality_risk"] or 0.0) if total else 0.0,
        "top_unit": units[0][0] if units else "N/A",
    }
    return {"slice_rows": slice_rows, "unit_alert_rates": units, "kpis": kpis}


def run_icu_job(
    spark: SparkSession,
    source: str | DataFrame,
    output_path: str,
    n_slices: int = S.ICU_DEFAULT_SLICES,
    keep_scratch: bool = False,
) -> tuple[DataFrame, dict[str, object]]:
    """Transform, write the preprocessed CSV, and report per-slice rows, unit rates and KPIs.

    Returns the written table (read back lazily with its schema) and the report,
    which is computed from that table: the slices are ranked and transformed once.
    A CSV source (a path) is parsed once: staged as Parquet under the shared
    checkpoint folder while malformed rows are counted, so the ranking's
    sampling and shuffle passes read Parquet columns. Staged input and the
    materialised slice ranking are removed at the end (unless ``keep_scratch``).
    """
    scratch = []
    corrupt_rows = 0
    if isinstance(source, str):
        counted = Observation("icu_input")
        raw = files.read_csv(spark, source, S.ICU_SCHEMA, keep_corrupt=True)
        observed = raw.observe(counted, F.count(F.col(files.CORRUPT_COLUMN)).alias("corrupt"))
        staged_path = shared_scratch_path(spark, "icu-staged")
        files.write_parquet(observed.drop(files.CORRUPT_COLUMN), staged_path)
        scratch.append(staged_path)
        corrupt_rows = int(counted.get["corrupt"])
        raw = files.read_parquet(spark, staged_path, S.ICU_SCHEMA)
    else:
        raw = source
    ranking_path = shared_scratch_path(spark, "icu-ranking")
    scratch.append(ranking_path)
    preprocessed = preprocess_icu_sliced(raw, n_slices, path=ranking_path)
    files.write_csv(preprocessed, output_path)
    written = files.read_icu_preprocessed_csv(spark, output_path)
    report = icu_report(written, n_slices)
    if not keep_scratch:
        for path in scratch:
            remove_path(spark, path)
    return written, report | {"output_path": output_path, "corrupt_rows": corrupt_rows}


def release_icu_job(
    spark: SparkSession, source: str | DataFrame, root: str, n_slices: int = S.ICU_DEFAULT_SLICES, keep: int = 2
) -> tuple[DataFrame, dict[str, object]]:
    """:func:`run_icu_job` into a new version below ``root``, published when its output stands; the last ``keep`` releases stay."""
    releases = Releases(spark, root)
    with releases.new() as version:
        written, report = run_icu_job(spark, source, f"{version}/preprocessed", n_slices)
        number = releases.publish(version, {"preprocessed": f"{version}/preprocessed"}, kpis=report["kpis"], corrupt_rows=report["corrupt_rows"])
    releases.retire(keep)
    return written, report | {"number": number}
