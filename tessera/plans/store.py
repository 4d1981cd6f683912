"""Versioned tables: Parquet snapshots and one manifest that names the current ones.

A commit writes every snapshot first and then replaces the manifest in one rename, so that readers
see all of a run or nothing, and each run's state stays readable until it expires. Tables of history
are appended to: a commit adds a folder of its own rows, and the folders are put together when they
are many.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.grouping import MERGED
from tessera.session import materialize

SAME_JOB = timedelta(days=60)

_FIELDS = "title string, company string, location string, work_mode string, salary_min bigint, salary_max bigint, salary_currency string, salary_text string, posted_at timestamp_ntz, description string"
SCHEMAS = {
    "runs": "run_id int, mode string, started_at timestamp_ntz, finished_at timestamp_ntz, status string",
    "jobs": f"job_id string, canonical_url string, dedup_key string, {_FIELDS}, content_hash string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz, first_run_id int, last_run_id int",
    "job_sources": "source string, source_job_id string, job_id string, url string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz, last_run_id int",
    "rejections": "run_id int, seq bigint, stage string, source string, source_job_id string, rule string, detail string",
    "source_stats": "run_id int, source string, payloads bigint, records bigint, rejected bigint, filtered bigint, kept bigint",
    "enrichments": "job_id string, content_hash string, profile_hash string, provider string, model string, seniority string, stack array<string>, affinity int, rationale string, enriched_at timestamp_ntz",
}


#: Tables that only grow, and the folders of one that are put together.
HISTORY, FOLDERS = ("rejections", "source_stats"), 64


class Tables:
    """Named tables that are given, read as those of a store are."""

    def __init__(self, tables: dict[str, DataFrame]):
        self.tables = tables

    def has(self, table: str) -> bool:
        return table in self.tables

    def read(self, table: str) -> DataFrame:
        return self.tables[table]


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._manifest = self._path(f"{self.root}/manifest.json")
        self._files = self._manifest.getFileSystem(self._conf)

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def manifest(self) -> dict[str, list[str]]:
        """Folders of the current state by table."""
        if not self._files.exists(self._manifest):
            return {}
        return json.loads("".join(r[0] for r in self.spark.read.text(f"{self.root}/manifest.json", wholetext=True).collect()))

    def has(self, table: str) -> bool:
        return table in self.manifest()

    def read(self, table: str, manifest: dict[str, list[str]] | None = None) -> DataFrame:
        """The current state; manifest: of another one."""
        folders = (self.manifest() if manifest is None else manifest).get(table)
        if not folders:
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).parquet(*[f"{self.root}/{f}" for f in folders])

    def commit(self, tables: dict[str, DataFrame], run_id: int) -> dict[str, list[str]]:
        """Write new snapshots of these tables, or new rows of history, and make them current, all at once."""
        manifest = self.manifest()
        for table, df in tables.items():
            old = manifest.get(table, []) if table in HISTORY else []
            if len(old) >= FOLDERS:
                df, old = self.read(table, {table: old}).unionByName(df.select(*_columns(table))), []
            folder = f"{table}/v={run_id}-{uuid.uuid4().hex[:12]}"
            empty = self.spark.createDataFrame([], SCHEMAS[table])
            empty.unionByName(df.select(*empty.columns)).write.parquet(f"{self.root}/{folder}")
            manifest[table] = [*old, folder]
        self._replace(json.dumps(manifest, sort_keys=True))
        return manifest

    def expire(self, before_run: int) -> list[str]:
        """Remove the folders that runs before this one have written and that are no part of the current state."""
        kept, gone = {f for folders in self.manifest().values() for f in folders}, []
        for table in SCHEMAS:
            top = self._path(f"{self.root}/{table}")
            for entry in self._files.listStatus(top) if self._files.exists(top) else []:
                name = f"{table}/{entry.getPath().getName()}"
                if name not in kept and int(name.split("v=")[1].split("-")[0]) < before_run:
                    self._files.delete(entry.getPath(), True)
                    gone.append(name)
        return gone

    def _replace(self, text: str) -> None:
        fresh = self._path(f"{self.root}/manifest-{uuid.uuid4().hex}.json")
        out = self._files.create(fresh)
        out.write(bytearray(text.encode()))
        out.close()
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        over = self.spark.sparkContext._gateway.new_array(options, 1)
        over[0] = options.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), self._conf).rename(fresh, self._manifest, over)

    def start_run(self, mode: str, now: datetime) -> int:
        runs = self.read("runs")
        run_id = (runs.agg(F.max("run_id")).first()[0] or 0) + 1
        row = self.spark.createDataFrame([(run_id, mode, now, None, "running")], SCHEMAS["runs"])
        self.commit({"runs": runs.unionByName(row)}, run_id)
        return run_id

    def finish_run(self, run_id: int, status: str, at: datetime) -> None:
        mine = F.col("run_id") == run_id
        runs = self.read("runs").withColumns({
            "status": F.when(mine, status).otherwise(F.col("status")),
            "finished_at": F.when(mine, F.lit(at).cast("timestamp_ntz")).otherwise(F.col("finished_at")),
        })
        self.commit({"runs": runs}, run_id)


@dataclass
class Loaded:
    """new_jobs and seen_again count groups; new_links links that were unknown before."""

    jobs: DataFrame
    job_sources: DataFrame
    new_jobs: int
    seen_again: int
    new_links: int


def _columns(table: str) -> list[str]:
    return [c.split()[0] for c in SCHEMAS[table].split(", ")]


def content_hash() -> Column:
    said = F.struct(*sorted(("title", "company", "location", "description", "salary_text")))
    return F.sha2(F.to_json(said, {"ignoreNullFields": "false"}), 256)


def job_id_of(url: Column) -> Column:
    return F.concat(F.lit("j"), F.substring(F.sha1(url), 1, 15))


def match_groups(groups: DataFrame, jobs: DataFrame, job_sources: DataFrame, now: datetime, window: timedelta = SAME_JOB) -> DataFrame:
    """groups with matched: the stored job of the first known link, else of the URL, else of the key, the latest.

    Groups act in the order of group_seq: a job that an earlier group of the batch reached by link
    or URL counts as seen now, even if its own last sight is older than the window.
    """
    links = groups.select("group_seq", F.posexplode("links").alias("place", "link")).select("group_seq", "place", "link.source", "link.source_job_id")
    by_link = links.join(job_sources.select("source", "source_job_id", "job_id"), ["source", "source_job_id"]).groupBy("group_seq").agg(F.min_by("job_id", "place").alias("by_link"))
    by_url = groups.select("group_seq", "canonical_url").join(jobs.select("canonical_url", "job_id"), "canonical_url").groupBy("group_seq").agg(F.min("job_id").alias("by_url"))
    found = groups.join(by_link, "group_seq", "left").join(by_url, "group_seq", "left")
    known = found.withColumn("early", F.coalesce("by_link", "by_url"))
    clock = F.lit(now).cast("timestamp_ntz")
    # of a key's jobs the last seen one; reached ones count as seen now from their group on, and times of sight aren't later
    inside = jobs.where((F.col("dedup_key").isNotNull()) & (F.col("last_seen_at") >= F.lit(now - window).cast("timestamp_ntz")))
    latest = inside.groupBy("dedup_key").agg(F.max(F.struct(F.col("last_seen_at").alias("seen"), "job_id")).alias("latest"))
    touched = known.where("early IS NOT NULL").groupBy(F.col("early").alias("job_id")).agg(F.min("group_seq").alias("group_seq"))
    reached = touched.join(jobs.where("dedup_key IS NOT NULL").select("job_id", "dedup_key"), "job_id").select("dedup_key", "group_seq", F.struct(clock.alias("seen"), "job_id").alias("reached"))
    asking = known.where("early IS NULL AND dedup_key IS NOT NULL").select("dedup_key", "group_seq", F.lit(None).cast(reached.schema["reached"].dataType).alias("reached"))
    so_far = Window.partitionBy("dedup_key").orderBy("group_seq").rowsBetween(Window.unboundedPreceding, -1)
    ranked = reached.unionByName(asking).withColumn("before", F.max("reached").over(so_far)).where("reached IS NULL")
    best = F.greatest(F.col("before"), F.col("latest"))
    by_key = ranked.join(latest, "dedup_key", "left").select("group_seq", best["job_id"].alias("by_key"))
    return known.join(by_key, "group_seq", "left").withColumn("matched", F.coalesce("early", "by_key")).drop("by_link", "by_url", "early", "by_key")


def load_groups(store: Store | Tables, groups: DataFrame, run_id: int, now: datetime, window: timedelta = SAME_JOB) -> Loaded:
    """Jobs and links after the load: stored values win, gaps are filled, links never move."""
    jobs, job_sources = store.read("jobs"), store.read("job_sources")
    clock, run = F.lit(now).cast("timestamp_ntz"), F.lit(run_id)
    matched = materialize(match_groups(groups, jobs, job_sources, now, window), "matched").withColumn("job_id", F.coalesce("matched", job_id_of(F.col("canonical_url"))))
    counts = matched.agg(F.count_if(F.col("matched").isNull()).alias("new"), F.count_if(F.col("matched").isNotNull()).alias("again")).first()

    seen = {"last_seen_at": clock, "last_run_id": run, "content_hash": content_hash()}
    added = matched.where("matched IS NULL").withColumns(seen | {"first_seen_at": clock, "first_run_id": run}).select(*jobs.columns)
    fills = matched.where("matched IS NOT NULL").groupBy("job_id").agg(*[F.min_by(F.col(f), F.when(F.col(f).isNotNull(), F.col("group_seq"))).alias(f"fill_{f}") for f in MERGED]).withColumn("hit", F.lit(True))
    both = jobs.join(fills, "job_id", "left")
    for f in MERGED:
        both = both.withColumn(f, F.coalesce(f, f"fill_{f}"))
    for f, value in seen.items():
        both = both.withColumn(f, F.when(F.col("hit"), value).otherwise(F.col(f)))
    new_jobs = both.select(*jobs.columns).unionByName(added)

    came = matched.select("job_id", F.explode("links").alias("link")).select(F.col("link.source").alias("source"), F.col("link.source_job_id").alias("source_job_id"), F.col("job_id").alias("came_job"), F.col("link.url").alias("came_url"))
    merged = job_sources.join(came, ["source", "source_job_id"], "full")
    here = F.col("came_job").isNotNull()
    new_sources = merged.select(
        "source",
        "source_job_id",
        F.coalesce("job_id", "came_job").alias("job_id"),
        F.when(here, F.col("came_url")).otherwise(F.col("url")).alias("url"),
        F.coalesce("first_seen_at", clock).alias("first_seen_at"),
        F.when(here, clock).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
        F.when(here, run).otherwise(F.col("last_run_id")).alias("last_run_id"),
    )
    new_links = came.join(job_sources, ["source", "source_job_id"], "left_anti").count()
    return Loaded(new_jobs, new_sources, counts["new"], counts["again"], new_links)


def offending_rows(store: Store | Tables) -> dict[str, DataFrame]:
    """What breaks each check."""
    jobs, links = store.read("jobs"), store.read("job_sources")
    return {
        "jobs_missing_required": jobs.where("title = '' OR company = '' OR canonical_url = ''"),
        "duplicate_canonical_url": jobs.groupBy("canonical_url").count().where("count > 1"),
        "orphan_source_links": links.join(jobs, "job_id", "left_anti"),
        "job_without_sources": jobs.join(links, "job_id", "left_anti"),
    }


def check_counts(store: Store | Tables) -> DataFrame:
    """name and failing: the number of offending rows of every check."""
    counted = [df.agg(F.count("*").alias("failing")).select(F.lit(name).alias("name"), "failing") for name, df in offending_rows(store).items()]
    return reduce(DataFrame.unionByName, counted)


def load_checks(store: Store | Tables) -> dict[str, int]:
    """The number of offending rows by check, for the checks that fail."""
    return {r["name"]: r["failing"] for r in check_counts(store).where("failing > 0").collect()}
