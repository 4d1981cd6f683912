"""One run: payloads to postings, groups, stored jobs, checks, scores and a report."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tessera.operators.grouping import group_postings
from tessera.operators.rules import DEFAULT_ROLES
from tessera.plans import extract
from tessera.plans.enrich import Provider, choose_provider, enrich_jobs
from tessera.plans.profile import Profile
from tessera.plans.report import build_report, run_counts
from tessera.plans.store import Store, load_checks, load_groups
from tessera.session import materialize
from tessera.sources.boards import FIELDS


class ChecksFailed(Exception):
    """The stored tables break a load check; the data stay, the run is marked failed."""


@dataclass
class Summary:
    run_id: int
    new_jobs: int
    seen_again: int
    rejected: int
    filtered: int
    enrich: Row | None
    report: str
    stats: dict[str, dict[str, int]] = field(default_factory=dict)


def run(spark: SparkSession, payloads: DataFrame, root: str, profile: Profile | None = None, now: datetime | None = None, mode: str = "samples", provider_mode: str | None = None, provider: Provider | None = None, limit: int | None = None, roles=DEFAULT_ROLES) -> Summary:
    now = now or datetime.now(UTC).replace(tzinfo=None)
    store = Store(spark, root)
    run_id = store.start_run(mode, now)
    try:
        annotated = materialize(extract.annotate(payloads, now, roles), "annotated")
        groups = materialize(group_postings(annotated.where("outcome = 'kept'").select("seq", "source", *FIELDS)), "groups")
        loaded = load_groups(store, groups, run_id, now)
        stats = extract.source_stats(payloads, annotated).withColumn("run_id", F.lit(run_id))
        bad = extract.rejections(annotated).withColumn("run_id", F.lit(run_id))
        store.commit({
            "jobs": loaded.jobs,
            "job_sources": loaded.job_sources,
            "rejections": bad,
            "source_stats": stats,
        }, run_id)
        failures = load_checks(store)
        if failures:
            raise ChecksFailed(f"load checks failed: {failures}")
        scored, chosen = None, choose_provider(provider_mode, provider)
        if chosen is not None:
            if profile is None:
                raise ValueError("scoring needs a profile")
            scored = enrich_jobs(store, chosen, profile, run_id, now, limit)
        report = build_report(store, run_id)
        if scored is not None:
            stopped = f", stopped: {scored.stopped}" if scored.stopped else ""
            report += f"\n_Enrichment ({chosen.name}, {chosen.model}): {scored.enriched} enriched, {scored.failed} failed{stopped}._\n"
        store.finish_run(run_id, "ok", datetime.now(UTC).replace(tzinfo=None))
        counts = run_counts(store.read("jobs"), run_id).first()
        by_source = {r["source"]: {k: r[k] for k in ("payloads", "records", "rejected", "filtered", "kept")} for r in stats.collect()}
        return Summary(run_id, counts["new"], counts["again"], sum(s["rejected"] for s in by_source.values()), sum(s["filtered"] for s in by_source.values()), scored, report, by_source)
    except BaseException:
        store.finish_run(run_id, "failed", datetime.now(UTC).replace(tzinfo=None))
        raise
