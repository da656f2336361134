"""Catalog tables: layout, atomic switches, and the refinement step against them.

Parquet tables have no MERGE and no transactions. Every write here therefore goes to a new run
(partitions or a table of its own), and one ``CREATE OR REPLACE VIEW`` makes it visible. A run that
dies earlier leaves the old view, and the next run removes what it left. One writer per table at a
time.

A refinement run appends what it changed and nothing else. Reads take the newest row of each key, and
a folding run rewrites the slices of the table that have gathered many runs.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from chronolake.functions.specs import KEY, ORDER, EntitySpec
from chronolake.operators.decode import decode_payload, latest_per_key, with_row_hash
from chronolake.operators.incremental import consumption, unconsumed
from chronolake.operators.history import build_history
from chronolake.operators.layout import clustered
from chronolake.operators.scd2 import CLOSE_ROW, KEEP, SKIP, TOUCH, advance_fences, apply_actions, plan_actions
from chronolake.session import stored

# Columns of the raw log.
LOG_TYPES = {
    "topic": "string",
    "kafka_partition": "int",
    "kafka_offset": "bigint",
    "kafka_timestamp": "timestamp",
    "record_key": "string",
    "raw_value": "string",
    "operation": "string",
    "before_json": "string",
    "after_json": "string",
    "source_db": "string",
    "source_schema": "string",
    "pg_lsn": "bigint",
    "pg_tx_id": "bigint",
    "source_ts_ms": "bigint",
    "processed_at": "timestamp",
    "event_id": "string",
    "_cdc_order_lsn": "bigint",
}

LOG_PARTITION_TYPES = {"source_table": "string", "ingest_date": "date", "_batch_id": "bigint"}

# Declared columns of the marts.
MARTS = {
    "gold_user_analytics": {
        "user_id": "bigint",
        "full_name": "string",
        "email_domain": "string",
        "registration_date": "string",
        "total_orders": "bigint",
        "total_spent": "double",
        "avg_order_value": "double",
        "last_order_date": "timestamp",
        "recency_days": "int",
        "segment": "string",
        "refresh_date": "timestamp",
    },
    "gold_product_analytics": {
        "product_id": "bigint",
        "product_name": "string",
        "category": "string",
        "price": "double",
        "total_orders": "bigint",
        "total_revenue": "double",
        "unique_customers": "bigint",
        "revenue_last_30d": "double",
        "performance_tier": "string",
        "refresh_date": "timestamp",
    },
    "gold_sales_summary": {
        "date_key": "string",
        "total_orders": "bigint",
        "total_revenue": "double",
        "avg_order_value": "double",
        "unique_customers": "bigint",
        "top_product_id": "bigint",
        "refresh_date": "timestamp",
    },
}

# Buckets of the silver tables. At least the cluster's shuffle width, so that the merge join keeps
# the stored layout and only the batch is shuffled.
BUCKETS = 512

# Parts of a silver table that are folded apart; each holds whole buckets.
SLICES = 16

# Runs a slice may gather before it is folded.
FOLD_AFTER = 16

# Keys of a batch that are broadcast to the open rows (8 bytes each); larger batches meet them by bucket.
BROADCAST_KEYS = 1_000_000

# Rows of a batch for each task that writes them.
ROWS_PER_TASK = 200_000

_RUN = "chronolake.run"
_WATERMARK = "chronolake.watermark"
_CONSUMED = "chronolake.consumed"
_FOLDED = "chronolake.folded"


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def ensure_log_table(spark: SparkSession, name: str, location: str) -> None:
    """Raw log under a catalog name; call ``recover`` after new batches.

    Split ingest writes a folder for each batch: an external table, partitioned by batch, too. The plain log
    writer keeps a commit log instead: a view of the folder, which follows that log (files of failed batches
    don't show) and its partitions. A name made for the other layout is an error, as it would show no rows.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(location)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    with_commit_log = system.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, "_spark_metadata"))
    if exists(spark, name):
        if with_commit_log != _is_view(spark, name):
            raise ValueError(f"{name} was made for the other log writer than that of {location}")
    elif with_commit_log:
        spark.sql(f"CREATE VIEW {name} AS SELECT * FROM parquet.`{location}`")
    else:
        spark.sql(
            f"CREATE TABLE {name} ({_ddl({**LOG_TYPES, **LOG_PARTITION_TYPES})}) USING parquet "
            f"PARTITIONED BY ({', '.join(LOG_PARTITION_TYPES)}) LOCATION '{location}'"
        )


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "VIEW"


def recover(spark: SparkSession, name: str) -> None:
    if not _is_view(spark, name):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def _ddl(types: Mapping[str, str]) -> str:
    return ", ".join(f"`{name}` {type_name}" for name, type_name in types.items())


def _properties(spark: SparkSession, view: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}


def _committed_run(spark: SparkSession, view: str) -> int:
    """Number of the run the view shows; 0 before the first."""
    return int(_properties(spark, view)[_RUN])


def _insert_run(rows: DataFrame, table: str) -> None:
    """Write the run's partitions, replacing files a dead attempt may have left in them."""
    conf, mode = rows.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    previous = conf.get(mode)
    conf.set(mode, "dynamic")
    try:
        rows.select(*rows.sparkSession.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        conf.set(mode, previous)


def _partitions(spark: SparkSession, table: str) -> list[dict[str, str]]:
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return [dict(part.split("=", 1) for part in row[0].split("/")) for row in rows]


def _drop_partition(spark: SparkSession, table: str, part: Mapping[str, str]) -> None:
    spec = ", ".join(f"{name} = '{value}'" for name, value in part.items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


# Kinds of partitions of a silver table. Open rows: a folded slice, or a run's new, touched and dropped rows.
# Closed rows: those of one run, or of the runs that one fold put together.
_BASE, _DELTA, _CLOSED, _PACK = "base", "delta", "closed", "pack"


@dataclass(frozen=True)
class _State:
    """What the view shows.

    ``since``: the run of the last rebuild, earlier ones don't count. ``fences``: the run that holds all fences
    up to it. ``packed``: for each slice, the run up to which closed rows lie in packs.
    """

    run: int
    watermark: int | None = None
    consumed: int | None = None
    since: int = 0
    fences: int = 0
    packed: Mapping[int, int] = field(default_factory=dict)


@dataclass(frozen=True)
class SilverTable:
    """Type 2 history of one entity.

    ``versions`` is bucketed by id and partitioned by kind, slice (a set of buckets) and run. A run appends the
    rows it opened or touched, a marker for each key it left without an open row, and the rows it closed. The
    open row of a key is its newest one: a read ranks the few runs within each bucket, without a shuffle.
    ``view`` shows the open and the closed rows of the committed run; a filter on ``_is_current`` prunes the
    other kind. ``fences`` keeps the order keys of deletes, of which the greatest counts.

    ``fold`` rewrites only slices that have gathered many runs, so over time a row is rewritten once for every
    ``FOLD_AFTER`` runs that change its slice, whatever the size of the table.
    """

    database: str
    spec: EntitySpec
    buckets: int = BUCKETS

    @property
    def view(self) -> str:
        return f"{self.database}.silver_{self.spec.name}"

    @property
    def versions(self) -> str:
        return f"{self.view}_versions"

    @property
    def fences(self) -> str:
        return f"{self.view}_fences"

    @property
    def staging(self) -> str:
        return f"{self.view}_staging"

    def create(self, spark: SparkSession) -> None:
        types = self.spec.silver_types()
        business = {**{c: types[c] for c in self._business_and_audit()}, "_hash": "string"}
        order = {c: types[c] for c in ORDER}
        fence = f"struct<{','.join(f'{c}:{t}' for c, t in order.items())}>"
        versions = {**{k: v for k, v in types.items() if k != "_is_current"}, "_dropped": "boolean", "_fresh": "boolean"}
        layouts = {
            self.versions: (versions, ["_kind", "_slice", "_run_id"]),
            self.fences: ({KEY: types[KEY], "fence": fence}, ["_run_id"]),
            self.staging: (business, ["_run_id"]),
        }
        partition_types = {"_run_id": "bigint", "_kind": "string", "_slice": "int"}
        for table, (columns, partitions) in layouts.items():
            ddl = _ddl({**columns, **{p: partition_types[p] for p in partitions}})
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet OPTIONS (compression 'zstd') "
                f"PARTITIONED BY ({', '.join(partitions)}) "
                f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self.buckets} BUCKETS"
            )
        if not exists(spark, self.view):
            self._show(spark, _State(0))

    def _business_and_audit(self) -> list[str]:
        types = self.spec.silver_types()
        return [c for c in types if not c.startswith("_")]

    # --- what is committed ---

    def _state(self, spark: SparkSession) -> _State:
        kept = _properties(spark, self.view)
        folded = json.loads(kept.get(_FOLDED, "{}"))
        number = lambda name: int(kept[name]) if name in kept else None
        packed = {int(k): v for k, v in folded.get("packed", {}).items()}
        return _State(int(kept[_RUN]), number(_WATERMARK), number(_CONSUMED), folded.get("since", 0), folded.get("fences", 0), packed)

    def _show(self, spark: SparkSession, state: _State) -> None:
        """Commit: show ``state.run``, and keep with it what was consumed and its newest event time.

        The mark of consumption decides what the next run reads; the event time is for reports only.
        """
        folded = json.dumps({"since": state.since, "fences": state.fences, "packed": state.packed})
        kept = {_RUN: state.run, _WATERMARK: state.watermark, _CONSUMED: state.consumed, _FOLDED: folded}
        properties = ", ".join(f"'{name}' = '{value}'" for name, value in kept.items() if value is not None)
        columns = {current: ", ".join("{0} AS `_is_current`".format(current) if c == "_is_current" else f"`{c}`"
                                      for c in self.spec.silver_types()) for current in ("true", "false")}
        spark.sql(
            f"CREATE OR REPLACE VIEW {self.view} TBLPROPERTIES ({properties}) AS "
            f"SELECT {columns['true']} FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY _run_id DESC) AS _rank "
            f"FROM {self.versions} WHERE {self._open_condition(state)}) WHERE _rank = 1 AND NOT _dropped "
            f"UNION ALL SELECT {columns['false']} FROM {self.versions} WHERE {self._closed_condition(state)}"
        )

    def _open_condition(self, state: _State) -> str:
        return f"_kind IN ('{_BASE}', '{_DELTA}') AND _run_id BETWEEN {state.since} AND {state.run}"

    def _closed_condition(self, state: _State) -> str:
        """Packs, and closed rows of the runs after the last pack of their slice; all decided by partitions."""
        floors: dict[int, list[int]] = {}
        for part, run in state.packed.items():
            floors.setdefault(run, []).append(part)
        loose = [f"(_slice IN ({', '.join(map(str, sorted(parts)))}) AND _run_id > {run})" for run, parts in sorted(floors.items())]
        if state.packed:
            loose.append(f"_slice NOT IN ({', '.join(map(str, sorted(state.packed)))})")
        unpacked = f" AND ({' OR '.join(loose)})" if loose else ""
        return (
            f"_run_id BETWEEN {state.since} AND {state.run} "
            f"AND (_kind = '{_PACK}' OR (_kind = '{_CLOSED}'{unpacked}))"
        )

    def open_rows(self, spark: SparkSession, run: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """Open rows of the committed run, or of an earlier one; only those of ``keys`` where given."""
        state = self._state(spark)
        rows = spark.table(self.versions).where(self._open_condition(state if run is None else replace(state, run=run)))
        if keys is not None:
            rows = rows.join(keys, KEY, "left_semi")
        newest = Window.partitionBy(KEY).orderBy(F.col("_run_id").desc())
        ranked = rows.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1 AND NOT _dropped")
        return ranked.drop("_rank", "_dropped", "_fresh").withColumn("_is_current", F.lit(True))

    def _known_fences(self, spark: SparkSession, state: _State) -> DataFrame:
        return spark.table(self.fences).where(F.col("_run_id").between(max(state.since, state.fences), state.run))

    def _slice(self) -> Column:
        """The slice of a row: a function of its bucket."""
        return (F.pmod(F.hash(KEY), F.lit(self.buckets)) % min(SLICES, self.buckets)).cast("int")

    def _clean(self, spark: SparkSession, state: _State) -> None:
        """Remove what no view shows: runs that died, and what folds have replaced.

        What the last run replaced stays for readers that still use the view before it. The oldest runs go
        first: a key's marker must not go before the rows it hides.
        """
        found = sorted(_partitions(spark, self.versions), key=lambda p: int(p["_run_id"]))
        bases: dict[str, int] = {}
        for p in found:
            if p["_kind"] == _BASE and int(p["_run_id"]) < state.run:
                bases[p["_slice"]] = max(bases.get(p["_slice"], 0), int(p["_run_id"]))
        for p in found:
            run, part = int(p["_run_id"]), p["_slice"]
            packed = state.packed.get(int(part), 0)
            died = run > state.run
            rebuilt = run < state.since < state.run
            folded = p["_kind"] in (_BASE, _DELTA) and run < bases.get(part, 0)
            put_together = p["_kind"] == _CLOSED and run <= packed < state.run
            if died or rebuilt or folded or put_together:
                _drop_partition(spark, self.versions, p)
        for p in _partitions(spark, self.fences):
            run = int(p["_run_id"])
            if run > state.run or (run < max(state.since, state.fences) and max(state.since, state.fences) < state.run):
                _drop_partition(spark, self.fences, p)
        for p in _partitions(spark, self.staging):
            if not state.run - 2 < int(p["_run_id"]) <= state.run:
                _drop_partition(spark, self.staging, p)

    def committed_run(self, spark: SparkSession) -> int:
        return self._state(spark).run

    def changes(self, spark: SparkSession, after: int) -> tuple[DataFrame, DataFrame] | None:
        """Versions opened and closed by the runs after ``after``, up to the committed one.

        Only the partitions of those runs are read. Rows that were merely touched are the same versions and
        don't show. None where a rebuild or a fold has removed a run since: read the whole table then.
        """
        state = self._state(spark)
        runs = [int(p["_run_id"]) for p in _partitions(spark, self.versions) if p["_kind"] == _BASE]
        if state.since > after or any(after + 1 < run < state.run for run in runs):
            return None
        rows = spark.table(self.versions).where((F.col("_run_id") > after) & (F.col("_run_id") <= state.run))
        columns = [c for c in self.spec.silver_types() if c != "_is_current"]
        opened = rows.where((F.col("_kind") == _DELTA) & F.col("_fresh") & ~F.col("_dropped"))
        return opened.select(columns), rows.where(F.col("_kind") == _CLOSED).select(columns)

    # --- steps ---

    def refine(
        self,
        log: DataFrame,
        effective_at: Column | None = None,
    ) -> dict[str, int] | None:
        """One incremental step over all events that no committed run has read; None when there are none.

        What is read goes by deliveries (see ``unconsumed``), never by event time: late events, events
        without or with an absurd time, and all that follow them are read once each. A repeated read
        would change nothing, as older events never change newer rows.

        Counts in the result: keys staged, rows opened or touched, rows closed, and events without a key,
        which stay in the raw log.

        The decoded batch is staged first, so the steps after it read a table instead of parsing
        the log again, and a lost executor costs little. Only open rows and fences of its keys are looked at,
        and only what it changes is written.
        """
        spark = log.sparkSession
        self.create(spark)
        state = self._state(spark)
        self._clean(spark, state)
        run = state.run + 1

        read, decoded = Observation(), Observation()
        keyed = self._decoded(log, state.consumed, read, decoded)
        staged_count = Observation()
        batch = with_row_hash(latest_per_key(keyed), self.spec).observe(staged_count, F.count(F.lit(1)).alias("rows"))
        _insert_run(batch.withColumn("_run_id", F.lit(run).cast("bigint")), self.staging)
        keys_staged = staged_count.get["rows"]
        if keys_staged == 0:
            return None
        consumed = max((n for n in (state.consumed, read.get["consumed"]) if n is not None), default=None)

        staged = spark.table(self.staging).where(F.col("_run_id") == run).drop("_run_id")
        keys = staged.select(KEY)
        if keys_staged <= BROADCAST_KEYS:
            keys = F.broadcast(keys)
        known = self._known_fences(spark, state).join(keys, KEY, "left_semi").groupBy(KEY).agg(F.max("fence").alias("fence"))
        stamp = F.current_timestamp() if effective_at is None else effective_at
        planned = plan_actions(self.open_rows(spark, state.run, keys), staged, self.spec, known)
        planned = stored(planned.where(~F.col("action").isin(KEEP, SKIP)), "planned")
        counts = Observation()
        touch = F.col("action") == TOUCH
        rows = apply_actions(planned.where(~touch), self.spec, stamp).withColumn("_fresh", F.lit(True))
        rows = rows.unionByName(apply_actions(planned.where(touch), self.spec, stamp).withColumn("_fresh", F.lit(False))).observe(
            counts,
            F.count_if(F.col("_is_current")).alias("open"),
            F.count_if(~F.col("_is_current")).alias("closed"),
            F.max("source_ts_ms").alias("watermark"),
        )
        rows = rows.withColumn("_kind", F.when(F.col("_is_current"), _DELTA).otherwise(_CLOSED))
        rows = rows.drop("_is_current").withColumn("_dropped", F.lit(False))
        # A key that lost its open row and got no other one needs a marker over its older rows.
        markers = planned.where(F.col("action") == CLOSE_ROW).select(KEY, F.lit(_DELTA).alias("_kind"), F.lit(True).alias("_dropped"))
        self._append(rows.unionByName(markers, allowMissingColumns=True), run, keys_staged)
        fences = advance_fences(None, staged).withColumn("_run_id", F.lit(run).cast("bigint"))
        _insert_run(self._gathered(fences, keys_staged), self.fences)
        written = counts.get
        marks = [m for m in (state.watermark, written["watermark"]) if m is not None]
        self._show(spark, replace(state, run=run, watermark=max(marks, default=None), consumed=consumed))
        return {
            "staged": keys_staged,
            "open": written["open"],
            "closed": written["closed"],
            "keyless": decoded.get["keyless"],
        }

    def _decoded(self, log: DataFrame, consumed: int | None, read: Observation, decoded: Observation) -> DataFrame:
        events = unconsumed(log, self.spec.name, consumed).withColumn("_number", consumption(log))
        events = events.observe(read, F.max("_number").alias("consumed")).drop("_number")
        rows = decode_payload(events, self.spec).observe(decoded, F.count_if(F.col(KEY).isNull()).alias("keyless"))
        return rows.where(F.col(KEY).isNotNull())

    def _gathered(self, rows: DataFrame, count: int) -> DataFrame:
        """Rows of a bucket in one task, in as few tasks as their number needs: a bucket is one file."""
        wanted = -(-count // ROWS_PER_TASK)
        tasks = next(n for n in range(min(max(1, wanted), self.buckets), 0, -1) if self.buckets % n == 0)
        return rows.repartition(tasks, KEY)

    def _append(self, rows: DataFrame, run: int, count: int | None = None) -> None:
        rows = rows.withColumns({"_slice": self._slice(), "_run_id": F.lit(run).cast("bigint")})
        _insert_run(rows if count is None else self._gathered(rows, count), self.versions)

    def fold(self, spark: SparkSession, after: int = FOLD_AFTER) -> list[int]:
        """Rewrite the slices that hold more than ``after`` runs; returns their numbers.

        The open rows of such a slice become one base, its loose closed rows one pack (packs are not
        written again), and fences are merged when they hold more than ``after`` runs. Rows, order and
        content of the view stay as they are.
        """
        self.create(spark)
        state = self._state(spark)
        self._clean(spark, state)
        found = [(p["_kind"], int(p["_slice"]), int(p["_run_id"])) for p in _partitions(spark, self.versions)]
        bases: dict[int, int] = {}
        for kind, part, number in found:
            if kind == _BASE:
                bases[part] = max(bases.get(part, 0), number)
        runs: dict[int, set[int]] = {}  # what folds have replaced may still be there for readers
        for kind, part, number in found:
            if (kind == _DELTA and number > bases.get(part, 0)) or (kind == _CLOSED and number > state.packed.get(part, 0)):
                runs.setdefault(part, set()).add(number)
        parts = sorted(part for part, numbers in runs.items() if len(numbers) > after)
        fences = [int(p["_run_id"]) for p in _partitions(spark, self.fences)]
        many_fences = len([number for number in fences if number > state.fences]) > after
        if not parts and not many_fences:
            return []
        run = state.run + 1
        folded = replace(state, run=run, packed={**state.packed, **{part: state.run for part in parts}})
        if parts:
            within = F.col("_slice").isin(parts)
            base = self.open_rows(spark).where(within).drop("_is_current", "_run_id", "_slice")
            base = base.withColumns({"_kind": F.lit(_BASE), "_dropped": F.lit(False), "_fresh": F.lit(False)})
            loose = spark.table(self.versions).where(self._closed_condition(state)).where(within & (F.col("_kind") == _CLOSED))
            self._append(base, run)
            self._append(loose.drop("_run_id", "_slice").withColumn("_kind", F.lit(_PACK)), run)
        if many_fences:
            merged = self._known_fences(spark, state).groupBy(KEY).agg(F.max("fence").alias("fence"))
            _insert_run(merged.withColumn("_run_id", F.lit(run).cast("bigint")), self.fences)
            folded = replace(folded, fences=run)
        self._show(spark, folded)
        return parts

    def rebuild(self, log: DataFrame) -> dict[str, int]:
        """Replace the table by the complete history in the log: every change of every key, in commit time.

        For a first load, or after a change of rules. Later runs of ``refine`` go on from it. Counts in the
        result: rows open, rows closed, events without a key.
        """
        spark = log.sparkSession
        self.create(spark)
        state = self._state(spark)
        self._clean(spark, state)
        run = state.run + 1
        read, decoded = Observation(), Observation()
        events = stored(self._decoded(log, None, read, decoded), "rebuilt-events")
        counts = Observation()
        history = build_history(events, self.spec).observe(
            counts, F.count_if(F.col("_is_current")).alias("open"), F.count_if(~F.col("_is_current")).alias("closed")
        )
        history = history.withColumns(
            {
                "_kind": F.when(F.col("_is_current"), _BASE).otherwise(_PACK),
                "_dropped": F.lit(False),
                "_fresh": F.lit(True),
            }
        )
        self._append(history.drop("_is_current").repartition(self.buckets, KEY), run)
        fences = advance_fences(None, events).withColumn("_run_id", F.lit(run).cast("bigint"))
        _insert_run(fences.repartition(self.buckets, KEY), self.fences)
        newest = events.agg(F.max("source_ts_ms").alias("t")).first()["t"]
        self._show(spark, _State(run, newest, read.get["consumed"], since=run, fences=run))
        return {**counts.get, "keyless": decoded.get["keyless"]}


def compact_log(log: DataFrame, name: str, files: int) -> int:
    """A clustered copy of log rows under the view ``name``: few large files that reads by row or time can skip.

    For days that are complete; refinement goes on reading the log itself. ``_row_id`` is the id in the row
    image, null where it has none or no number. The copy is made as a whole and shown by one switch of the view.
    """
    image = F.coalesce("after_json", "before_json")
    rows = log.withColumn("_row_id", F.get_json_object(image, f"$.{KEY}").try_cast("bigint"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return publish(clustered(rows, ("_row_id", "source_ts_ms"), files), name, types)


def publish(rows: DataFrame, name: str, types: Mapping[str, str]) -> int:
    """Replace a mart as a whole: write a new table, then point the view ``name`` at it.

    Returns the number of rows, counted while writing.
    """
    spark = rows.sparkSession
    run = (_committed_run(spark, name) if exists(spark, name) else 0) + 1
    counted = Observation()
    shaped = rows.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])
    shaped.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format("parquet").saveAsTable(
        f"{name}_v{run}"
    )
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_RUN}' = '{run}') AS SELECT * FROM {name}_v{run}")
    if run > 2:  # the table before stays for readers that still use it
        spark.sql(f"DROP TABLE IF EXISTS {name}_v{run - 2}")
    return counted.get["rows"]
