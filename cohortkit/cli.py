"""Command line: the steps a deployment runs, each as Spark jobs (spark-submit friendly).

    python -m cohortkit land     --kind reviews --input <json files> --root <warehouse>
    python -m cohortkit land-launches --pages <page files> --root <warehouse>
    python -m cohortkit build    --root <warehouse> --as-of 2024-06-01 [--no-gate]
    python -m cohortkit analyze  --root <warehouse> --as-of 2024-06-01
    python -m cohortkit stream   --kind reviews --input <folder> --root <warehouse> --checkpoint <dir>
    python -m cohortkit sync     --from <warehouse> --to <warehouse>

Tables live under ``<root>/raw``, ``<root>/marts`` and ``<root>/datasets`` as Parquet.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import params as P
from .session import build_session


def _delete(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder this module created (works on any Hadoop file system)."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def _raw_or_empty(spark: SparkSession, root: str, name: str) -> DataFrame:
    from .sources import registry
    if registry.exists(spark, registry.raw_path(root, name)):
        return registry.read_raw(spark, root, name)
    return spark.createDataFrame([], registry.RAW_SCHEMAS[name])


def land(spark: SparkSession, kind: str, input_path: str, root: str, max_rows: int | None = None,
         load_ts: str | None = None) -> dict:
    """Batch-land JSON lines into ``raw_<kind>``: quarantine bad rows, keep the first
    arrival per key, skip keys already landed.  Returns the ingest report.

    The first row of a key by file and place in it wins.  The input is parsed once for the good
    and once for the rejected rows, into scratch tables in the shared checkpoint folder; the
    report, the append and the quarantine read those.  Landing the same input again adds nothing.
    """
    import uuid

    from .session import checkpoint_dir
    from .sources import ingest, readers, registry
    from .sources.keyindex import KeyIndex
    reader, key, name = {"reviews": (readers.read_reviews, "review_id", "raw_reviews"),
                         "users": (readers.read_users, "user_id", "raw_users")}[kind]
    good, rejected = reader(spark, input_path)
    scratch = f"{checkpoint_dir(spark).rstrip('/')}/land-{name}-{uuid.uuid4().hex}"
    good.write.parquet(f"{scratch}/good")
    rejected.write.parquet(f"{scratch}/rejected")
    good = spark.read.parquet(f"{scratch}/good")
    rejected = spark.read.parquet(f"{scratch}/rejected")
    if max_rows:
        good = ingest.bounded_ingest(good, key, max_rows)
    ts = F.lit(load_ts).cast("timestamp_ntz") if load_ts else F.localtimestamp()
    good = good.withColumn("loaded_at", ts)
    index = KeyIndex(spark, registry.raw_path(root, name), key).refresh()
    new_rows = ingest.insert_ignore(good, None, key, readers.ARRIVAL, index).checkpoint(eager=True)
    report = {"inserted": new_rows.count(), "rejected": rejected.count()}
    report["duplicate"] = good.where(F.col(key).isNotNull()).count() - report["inserted"]
    registry.append_raw(new_rows, root, name)
    registry.append_once(rejected, f"{root.rstrip('/')}/quarantine/{name}")
    _delete(spark, scratch)  # both writes are committed; the parsed copy is no longer needed
    return report


def land_launches(spark: SparkSession, pages_path: str, root: str, load_ts: str | None = None,
                  fallback_prefix: str = P.LAUNCH_URL_PREFIX, max_pages: int | None = None) -> int:
    """Parse stored API pages (each carrying its ``page_no``) and append new launches (by
    product URL, the first by page and place wins) with fresh ids; pages after an error page, a
    missing or unreadable page or the last page, or beyond ``max_pages`` if given, are not used."""
    from .session import checkpoint_dir
    from .sources import ingest, readers, registry
    from .sources.keyindex import KeyIndex
    good, rejected = readers.parse_launch_pages(readers.read_launch_pages(spark, pages_path), fallback_prefix,
                                                max_pages)
    # The id assignment, the append and the quarantine reuse what was parsed.
    checkpoint_dir(spark)
    good, rejected = good.checkpoint(eager=True), rejected.checkpoint(eager=True)
    target = _raw_or_empty(spark, root, "raw_launches")
    start = (target.agg(F.max("id")).first()[0] or 0) + 1
    index = KeyIndex(spark, registry.raw_path(root, "raw_launches"), "product_url").refresh()
    new_rows = ingest.insert_ignore(good.drop("page_no"), None, "product_url", readers.ARRIVAL, index).checkpoint(eager=True)
    landed = ingest.land_with_audit(new_rows, "product_url", "id", "scraped_at", load_ts=load_ts, start_id=start)
    n = landed.count()
    registry.append_raw(landed, root, "raw_launches")
    registry.append_once(rejected, f"{root.rstrip('/')}/quarantine/raw_launches")
    return n


def build(spark: SparkSession, root: str, params, gate: bool = True) -> dict[str, str]:
    """Staging views -> quality gate -> marts.  ``params`` is a ``Params`` or an as-of date."""
    from .plans.build import run_build
    from .plans.models import Models
    if isinstance(params, dt.date):
        params = P.Params(as_of=params)
    models = Models.from_tables(spark, root, params)
    _, paths = run_build(spark, models, root, gate=gate)
    return paths


def analysis_datasets(marts: dict[str, DataFrame], params: P.Params,
                      events: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Every analysis and dashboard dataset, computed from the stored marts.

    ``events`` may hold stored Kaplan-Meier event tables (``km_events``,
    ``km_events_by_segment``); the curves then read those small tables instead of
    re-aggregating the per-user survival mart for every dataset.
    """
    from .operators import churn, datasets, metrics, survival
    surv = marts["fct_survival_inputs"]
    ret = marts["fct_retention_cohorts"]
    launch = marts["fct_launch_performance"]
    cat = marts["fct_category_performance"]
    km_in = survival.km_input(surv, params.min_reviews)
    events = events or {"km_events": survival.km_events(km_in),
                        "km_events_by_segment": survival.km_events(km_in, by="user_segment")}
    overall = survival.km_curve(events["km_events"], z=P.Z_95)
    seg_events = events["km_events_by_segment"].where(F.col("group_size") >= params.min_group)
    by_segment = survival.km_curve(seg_events, by="user_segment")
    med = F.min(F.when(F.col("survival_raw") <= 0.5, F.col("t")))
    training = churn.churn_training_set(surv, params.churn_days, params.min_reviews)
    return {
        "km_overall": overall.select("t", "at_risk", "observed", "censored", "survival",
                                     F.round(F.col("survival_raw") * 100, 4).alias("survival_pct")),
        "km_confidence": overall.select("t", "survival", "ci_lower", "ci_upper"),
        "km_by_segment": by_segment.select("user_segment", "t", "at_risk", "observed", "censored", "survival"),
        "km_median": survival.km_median(overall),
        "km_median_by_segment": survival.km_median(by_segment, by="user_segment"),
        "km_milestones": survival.km_at(overall, params.milestones),
        "segment_table": by_segment.groupBy("user_segment").agg(
            F.max("group_size").alias("users"), med.alias("median_survival_days")),
        "survival_summary": survival.survival_summary(km_in),
        "label_distribution": churn.label_distribution(training),
        "segment_survival_means": churn.segment_survival_means(training),
        "baseline_report": metrics.classification_report(churn.rule_score(training)),
        "overview_kpis": datasets.overview_kpis(surv, launch),
        "retention_curves": datasets.retention_curves(ret, params.cohort_lo, params.cohort_hi,
                                                      params.curve_max_month),
        "month1_by_year": datasets.month1_by_year(ret),
        "category_bars": datasets.category_bars(cat),
        "launch_scatter": datasets.launch_scatter(launch),
        "launch_share": datasets.launch_share(cat),
        "top_launches": datasets.top_launches(launch, params.top_n),
    }


def analyze(spark: SparkSession, root: str, params: P.Params, with_model: bool = True) -> dict[str, str]:
    from .operators import churn, metrics, survival
    from .sources import registry
    marts = registry.read_layer(spark, root, "marts", (
        "fct_survival_inputs", "fct_retention_cohorts", "fct_launch_performance", "fct_category_performance"))
    # The datasets show together, when the last one is written.
    with registry.new_layer(spark, root, "datasets") as written:
        # The per-user survival mart is aggregated once into the two event tables; every
        # curve, median and read-out is then derived from these small stored tables.
        km_in = survival.km_input(marts["fct_survival_inputs"], params.min_reviews)
        paths = {"km_events": written.write("km_events", survival.km_events(km_in)),
                 "km_events_by_segment": written.write("km_events_by_segment", survival.km_events(km_in, by="user_segment"))}
        out = analysis_datasets(marts, params, {n: spark.read.parquet(p) for n, p in paths.items()})
        if with_model:
            model, scored = churn.train_and_score(marts["fct_survival_inputs"], params.churn_days, params.min_reviews)
            importance = churn.feature_importance(model, spark)
            out.update({"churn_predictions": churn.displayed(scored),
                        "churn_model_report": metrics.classification_report(scored),
                        "churn_model_auc": metrics.roc_auc(scored), "feature_importance": importance,
                        "top_feature": churn.top_feature(importance)})
        paths.update({name: written.write(name, df) for name, df in out.items()})
    return paths


# The columns that a copy takes over, and the key, of each raw table.
SYNCED = {
    "raw_launches": (["name", "tagline", "upvotes", "category", "pricing_type", "launch_date", "product_url"],
                     "product_url"),
    "raw_users": (["user_id", "name", "review_count", "yelping_since", "fans", "average_stars"], "user_id"),
    "raw_reviews": (["review_id", "user_id", "business_id", "stars", "useful", "funny", "cool", "review_date"],
                    "review_id"),
}


def sync(spark: SparkSession, source_root: str, target_root: str, load_ts: str | None = None) -> dict[str, int]:
    """Copy the three raw tables to another root, insert-or-ignore by key; the target's audit columns
    and launch ids are its own.  Copying again adds nothing.  Returns the rows added per table."""
    from .session import checkpoint_dir
    from .sources import ingest, registry
    from .sources.keyindex import KeyIndex
    checkpoint_dir(spark)
    added = {}
    for name, (columns, key) in SYNCED.items():
        if not registry.exists(spark, registry.raw_path(source_root, name)):
            continue
        target = _raw_or_empty(spark, target_root, name)
        index = KeyIndex(spark, registry.raw_path(target_root, name), key).refresh()
        new_rows = ingest.sync_table(registry.read_raw(spark, source_root, name), None, columns, key, index)
        # Cut from the index, which follows the target that the rows are appended to.
        new_rows = new_rows.checkpoint(eager=True)
        added[name] = new_rows.count()
        if name == "raw_launches":
            start = (target.agg(F.max("id")).first()[0] or 0) + 1
            new_rows = ingest.land_with_audit(new_rows, key, "id", "scraped_at", load_ts=load_ts, start_id=start)
        else:
            new_rows = ingest.land_with_audit(new_rows, key, None, "loaded_at", load_ts=load_ts)
        registry.append_raw(new_rows, target_root, name)
    return added


def stream(spark: SparkSession, kind: str, input_dir: str, root: str, checkpoint: str,
           bytes_per_trigger: int = 64 << 30) -> None:
    from .sources import registry
    from .streaming.ingest_stream import stream_ingest
    name = f"raw_{kind}"
    q = stream_ingest(spark, input_dir, kind, registry.raw_path(root, name),
                      f"{root.rstrip('/')}/quarantine/{name}", checkpoint, bytes_per_trigger)
    q.awaitTermination()


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="cohortkit")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("land")
    a.add_argument("--kind", choices=["reviews", "users"], required=True)
    a.add_argument("--input", required=True)
    a.add_argument("--root", required=True)
    a.add_argument("--max-rows", type=int, default=None)
    a = sub.add_parser("land-launches")
    a.add_argument("--pages", required=True)
    a.add_argument("--root", required=True)
    a.add_argument("--max-pages", type=int, default=None)
    for name in ("build", "analyze"):
        a = sub.add_parser(name)
        a.add_argument("--root", required=True)
        a.add_argument("--as-of", required=True, type=dt.date.fromisoformat)
        a.add_argument("--inactive-months", type=int, default=P.INACTIVE_MONTHS)
        a.add_argument("--churn-days", type=int, default=P.CHURN_DAYS)
        a.add_argument("--min-reviews", type=int, default=P.MIN_REVIEWS)
        a.add_argument("--min-group", type=int, default=P.MIN_GROUP)
        a.add_argument("--cohort-from", type=dt.date.fromisoformat, default=None)
        a.add_argument("--cohort-to", type=dt.date.fromisoformat, default=None)
        if name == "build":
            a.add_argument("--no-gate", action="store_true")
            a.add_argument("--max-rows", type=int, default=None)
            a.add_argument("--dates-from", type=dt.date.fromisoformat, default=None)
            a.add_argument("--dates-to", type=dt.date.fromisoformat, default=None)
        else:
            a.add_argument("--no-model", action="store_true")
    a = sub.add_parser("stream")
    a.add_argument("--kind", choices=["reviews", "users"], required=True)
    a.add_argument("--input", required=True)
    a.add_argument("--root", required=True)
    a.add_argument("--checkpoint", required=True)
    a.add_argument("--bytes-per-trigger", type=int, default=64 << 30)
    a = sub.add_parser("sync")
    a.add_argument("--from", dest="source", required=True)
    a.add_argument("--to", dest="target", required=True)
    args = ap.parse_args(argv)
    spark = build_session()
    if args.cmd == "land":
        print(json.dumps(land(spark, args.kind, args.input, args.root, args.max_rows)))
    elif args.cmd == "land-launches":
        print(json.dumps({"landed": land_launches(spark, args.pages, args.root, max_pages=args.max_pages)}))
    elif args.cmd in ("build", "analyze"):
        params = P.Params(as_of=args.as_of, inactive_months=args.inactive_months, churn_days=args.churn_days,
                          min_reviews=args.min_reviews, min_group=args.min_group,
                          cohort_lo=args.cohort_from, cohort_hi=args.cohort_to)
        if args.cmd == "build":
            params = replace(params, dq_max_rows=args.max_rows, dq_date_lo=args.dates_from, dq_date_hi=args.dates_to)
            print(json.dumps(build(spark, args.root, params, gate=not args.no_gate)))
        else:
            print(json.dumps(analyze(spark, args.root, params, with_model=not args.no_model)))
    elif args.cmd == "sync":
        print(json.dumps(sync(spark, args.source, args.target)))
    else:
        stream(spark, args.kind, args.input, args.root, args.checkpoint, args.bytes_per_trigger)
