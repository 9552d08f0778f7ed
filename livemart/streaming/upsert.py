"""Keyed table without an external store: append per batch, merge on read (§7.4).

``write(df, batch_id)`` overwrites the folder ``<path>/batch_id=<id>/``, so a
replayed micro-batch replaces its own earlier attempt (idempotent).  The
view picks, per key, the row of the highest (order columns, batch id):
later batches supersede earlier ones, as an upsert would.  ``compact``
folds the batches up to a given id into one base (one row per key), and
reads then skip the folded batch folders by partition pruning, so the
merge on read stays proportional to the base plus recent batches.

``buckets`` lays each batch out by a hash of a key column: a look-up of a
micro-batch's keys (``view(keys=...)``) then reads only their buckets.

``repair`` rows live in their own folders
``<path>_repair/job=<job>/repair_id=<n>/``, so neither a micro-batch nor the
repair of another job can overwrite them.  Each carries the batch id of the
version it corrects: it wins over that version and earlier ones, and any
later batch wins over it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from livemart.operators.keyed import latest_per_key
from livemart.passes import in_passes, passes_for, shuffles_removed

BATCH_COL = "batch_id"
REPAIR_COL = "repair_id"
JOB_COL = "job"
BUCKET_COL = "bucket"
# a look-up filters on the folders of its keys up to this many (else it reads all and the semi join decides)
MAX_FOLDERS = 1000
# repeated keys up to this many are broadcast to the rows, which then stay where they are
MAX_REPEATS = 10_000


class KeyedTable:
    """A keyed table at ``path`` with key columns and an optional version order."""

    def __init__(self, path: str, key: Sequence[str], order: Sequence[str] = (),
                 keep: str | None = None, partition_by: Sequence[str] = (),
                 compact_every: int | None = None, buckets: int = 0, bucket_by: str | None = None,
                 schema: T.StructType | str | None = None, position: Sequence[str] = ()):
        self.path = path.rstrip("/")
        self.key = list(key)
        self.order = list(order)
        self.keep = keep  # boolean column: rows whose latest version is false are hidden
        # key columns to lay out as folders inside each batch (e.g. the day):
        # a filter on them prunes folders, and being keys it runs below the merge
        self.partition_by = [c for c in partition_by if c in self.key]
        self.compact_every = compact_every  # sinks fold the table every N batches
        self.buckets = buckets
        self.bucket_by = bucket_by or self.key[0]
        # without a schema it is that of the first write, or of a file that is already there
        self.schema = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
        self.position = list(position)  # columns that say where in the source a row stands

    def _bucket(self):
        return F.pmod(F.xxhash64(F.col(self.bucket_by).cast("string")), F.lit(self.buckets)).cast("int")

    def _save(self, df: DataFrame, path: str, more: bool = False) -> None:
        if self.schema is None:
            self.schema = df.drop(BATCH_COL).schema
        folders = list(self.partition_by)
        if self.buckets:
            # one task a bucket, or several where AQE finds it large
            df = df.withColumn(BUCKET_COL, self._bucket()).hint("rebalance", BUCKET_COL)
            folders.append(BUCKET_COL)
        w = df.write.mode("append" if more else "overwrite").option("compression", "zstd")
        if folders:
            w = w.partitionBy(*folders)
        w.parquet(path)

    def write(self, df: DataFrame, batch_id: int, more: bool = False) -> None:
        """Upsert one micro-batch (idempotent per ``batch_id``).

        A batch that comes in parts is the first part, which replaces what an earlier
        attempt left, and ``more`` parts.

        SNK3: a row whose (single, text) key is null gets a generated key, the
        ``position`` of the row in its source (file and row, or partition and
        offset): a replayed batch or a redelivered position regenerates the
        same key, equal rows of two positions stay two.  Without position
        columns the key is a hash of the content, and equal rows are one.
        """
        k = self.key[0]
        if len(self.key) == 1 and isinstance(df.schema[k].dataType, T.StringType):
            where = [F.col(c) for c in (self.position or df.columns)]
            generated = F.sha2(F.to_json(F.struct(*where), {"ignoreNullFields": "false"}), 256)
            df = df.withColumn(k, F.coalesce(F.col(k), generated))
        self._save(df.drop(*self.position), f"{self.path}/{BATCH_COL}={int(batch_id)}", more)

    def next_repair(self, spark: SparkSession) -> int:
        """The next free repair number, one more than that of any job's repairs."""
        repairs = self._read_if_there(spark, f"{self.path}_repair")
        last = repairs.agg(F.max(REPAIR_COL)).first()[0] if repairs is not None else None
        return (last or 0) + 1

    def next_batch(self, spark: SparkSession) -> int:
        """The batch number after all that the table holds."""
        batches = self._read_if_there(spark, self.path)
        last = batches.agg(F.max(BATCH_COL)).first()[0] if batches is not None else None
        return max(-1 if last is None else last, self._base_id(spark) or -1) + 1

    def repair(self, df: DataFrame, repair_id: int, job: str = "repair", more: bool = False) -> None:
        """Write corrected rows (idempotent per ``job`` and ``repair_id``, 1 or more).

        ``df`` has the table's columns and ``batch_id``, the version each
        row corrects (0 for a key that the stream never wrote).  ``more`` as in ``write``.
        """
        if repair_id < 1:
            raise ValueError("repair_id starts at 1")
        self._save(df, f"{self.path}_repair/{JOB_COL}={job}/{REPAIR_COL}={int(repair_id)}", more)
        # run again after it was folded: it counts anew
        spark = df.sparkSession
        upto, folded = self._base(spark)
        if (job, int(repair_id)) in folded:
            self._make_current(spark, upto, [x for x in folded if x != (job, int(repair_id))])

    def foreach_batch(self, transform=None, compact_every: int | None = None, first: int = 0):
        """A ``foreachBatch`` function: optional per-batch transform, then write.

        With a transform the micro-batch is persisted for the duration of the
        write, so a transform that reads it twice does not re-run the
        (stateful) micro-batch plan.  ``compact_every=N`` folds the table
        into its base after every N-th batch, so a long-running stream keeps
        its reads proportional to the base plus the last few batches.
        ``first`` is added to the batch numbers (``jobs.first_batch``).
        """
        def _fn(df: DataFrame, batch_id: int) -> None:
            batch_id += first
            if transform is None:
                self.write(df, batch_id)
            else:
                df.persist()
                try:
                    self.write(transform(df, batch_id), batch_id)
                finally:
                    df.unpersist()
            self.fold(df.sparkSession, batch_id, compact_every)
        return _fn

    def fold(self, spark: SparkSession, batch_id: int, compact_every: int | None = None) -> None:
        """Compact after every ``compact_every``-th batch, if the table or the caller asks for it."""
        every = compact_every or self.compact_every
        if every and batch_id > 0 and batch_id % every == 0:
            self.compact(spark, batch_id)

    def _base_id(self, spark: SparkSession) -> int | None:
        """Batch id folded into the current compacted base, or None."""
        return self._base(spark)[0]

    def _base(self, spark: SparkSession) -> tuple[int | None, list[tuple[str, int]]]:
        """Batch id and repairs (job, number) folded into the current base; (None, []) without one."""
        try:
            row = spark.read.schema(f"upto long, folded array<struct<{JOB_COL}: string, {REPAIR_COL}: long>>").parquet(
                f"{self.path}_base/current").first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None, []
        return (int(row["upto"]), [tuple(x) for x in row["folded"] or []]) if row else (None, [])

    def _make_current(self, spark: SparkSession, upto: int, folded: Sequence[tuple[str, int]]) -> None:
        pairs = [F.struct(F.lit(j).alias(JOB_COL), F.lit(r).cast("long").alias(REPAIR_COL)) for j, r in folded]
        held = F.array(*pairs).cast(f"array<struct<{JOB_COL}: string, {REPAIR_COL}: long>>")
        (spark.range(1).select(F.lit(int(upto)).cast("long").alias("upto"), held.alias("folded"))
              .write.mode("overwrite").parquet(f"{self.path}_base/current"))

    def _read_if_there(self, spark: SparkSession, path: str) -> DataFrame | None:
        """The table at ``path``, or None where no such path exists or it holds no
        file (rows laid out by folder leave none when there are none); other
        failures are raised."""
        try:
            return self._read(spark, path)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def _read(self, spark: SparkSession, path: str) -> DataFrame:
        """The rows under ``path`` with a stated schema: folder values stay text, whatever they look like."""
        schema = self.schema
        if schema is None:  # a table of another session: from a file, whose folders hold the rest
            found = spark.read.option("recursiveFileLookup", "true").parquet(path).schema
            schema = T.StructType([*found.fields, *[T.StructField(c, T.StringType()) for c in self.partition_by
                                                    if c not in found.names]])
        own = {BATCH_COL: "long", REPAIR_COL: "long", JOB_COL: "string", BUCKET_COL: "int"}
        folders = [] if not self.buckets else [BUCKET_COL]
        if path == self.path:
            folders.append(BATCH_COL)
        elif path == f"{self.path}_repair":
            folders += [JOB_COL, REPAIR_COL]
            schema = T.StructType([*schema.fields, T.StructField(BATCH_COL, T.LongType())]) if BATCH_COL not in schema.names else schema
        full = T.StructType([*[f for f in schema.fields if f.name not in folders],
                             *[T.StructField(c, T.DataType.fromDDL(own[c])) for c in folders]])
        return spark.read.schema(full).parquet(path)

    def raw(self, spark: SparkSession) -> DataFrame:
        """All live versions: the compacted base, the batches written after it, the repairs.

        Batches already folded into the base are skipped by a partition
        filter, so they are not even listed for reading; so are the rows of folded repairs.  A table that was
        never written is empty, if its schema is known.
        """
        upto, folded = self._base(spark)
        if self.schema is None:
            batches = self._read(spark, self.path)
        else:
            batches = self._read_if_there(spark, self.path)
            if batches is None:
                empty = [*self.schema.fields, *([T.StructField(BUCKET_COL, T.IntegerType())] if self.buckets else []),
                         T.StructField(BATCH_COL, T.LongType())]
                batches = spark.createDataFrame([], T.StructType(empty))
        if upto is not None:
            base = self._read(spark, f"{self.path}_base/v{upto}").withColumn(BATCH_COL, F.lit(upto).cast("long"))
            newer = batches.where(F.col(BATCH_COL) > upto)
            batches = base.unionByName(newer.select(*base.columns))
        rows = batches.withColumns({REPAIR_COL: F.lit(0).cast("long"), JOB_COL: F.lit("")})
        repairs = self._read_if_there(spark, f"{self.path}_repair")
        if repairs is not None:
            for job, number in folded:  # its rows of later batches than the base's are not in there
                own = (F.col(JOB_COL) == job) & (F.col(REPAIR_COL) == number)
                repairs = repairs.where(~own | F.coalesce(F.col(BATCH_COL) > upto, F.lit(True)))
            rows = rows.unionByName(repairs.select(*rows.columns))
        return rows

    def _merged(self, raw: DataFrame, cols: Sequence[str]) -> DataFrame:
        return latest_per_key(raw, self.key, [*self.order, BATCH_COL, REPAIR_COL, JOB_COL], cols)

    def _mostly_single(self, raw: DataFrame, cols: Sequence[str]) -> DataFrame:
        """As ``_merged``, where few keys have several versions: rows of the others stay where they are.

        Hashes of the keys are counted; the few that come more than once go through the merge,
        with whatever else has such a hash.  Many: all rows do.  Runs one job.
        """
        spark, spot = raw.sparkSession, F.xxhash64(*self.key)
        with shuffles_removed(spark):
            again = raw.select(spot.alias("_spot")).groupBy("_spot").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
            again = again.select("_spot").limit(MAX_REPEATS + 1).collect()
        if not again:
            return raw.select(*cols)
        if len(again) > MAX_REPEATS:
            return self._merged(raw, cols)
        few = F.broadcast(spark.createDataFrame(again, "_spot long"))
        single = raw.join(few, spot == few["_spot"], "left_anti")
        return single.select(*cols).unionByName(self._merged(raw.join(few, spot == few["_spot"], "left_semi"), cols))

    def _in_folders_of(self, raw: DataFrame, keys: DataFrame) -> DataFrame:
        """``raw`` cut to the folders that hold ``keys`` (values of a few folders go through the driver)."""
        columns = [c for c in self.partition_by if c in keys.columns]
        if self.buckets and self.bucket_by in keys.columns:
            keys = keys.withColumn(BUCKET_COL, self._bucket())
            columns.append(BUCKET_COL)
        for c in columns:
            values = [r[0] for r in keys.select(c).where(F.col(c).isNotNull()).distinct().limit(MAX_FOLDERS + 1).collect()]
            if len(values) <= MAX_FOLDERS:
                raw = raw.where(F.col(c).isin(values) if values else F.lit(False))
        return raw

    def view(self, spark: SparkSession, keys: DataFrame | None = None,
             with_batch: bool = False, before_repair: int | None = None,
             before_batch: int | None = None, columns: Sequence[str] | None = None,
             few_repeats: bool = False) -> DataFrame:
        """Latest version of every key (merge on read).

        ``keys`` (a DataFrame of some or all key columns) restricts the view to those
        keys: the raw versions are cut to their buckets and day folders and semi-joined
        *before* the per-key merge, so a lookup for one micro-batch reads and merges
        only what it needs.
        ``with_batch`` adds the batch id of the version shown (for ``repair``);
        ``before_repair`` leaves out that repair and later ones, so a repair
        run again reads what its first run read; ``before_batch`` leaves out that
        batch and later ones, so a replayed micro-batch does the same.
        ``columns`` narrows the view to these: the merge then moves no others (the
        optimizer cannot prune the row that the per-key pick packs).
        ``few_repeats``: for a whole table most of whose keys have one version; only rows of
        the others are moved (``_mostly_single``, which counts the keys at once).
        """
        raw = self.raw(spark)
        if before_repair is not None:
            raw = raw.where(F.col(REPAIR_COL) < before_repair)
        if before_batch is not None:
            raw = raw.where(F.col(BATCH_COL) < before_batch)
        if keys is not None:
            on = [c for c in self.key if c in keys.columns]
            keys = keys.select(*on).distinct()
            raw = self._in_folders_of(raw, keys).join(keys, on, "left_semi")
        hidden = {REPAIR_COL, JOB_COL, BUCKET_COL} | (set() if with_batch else {BATCH_COL})
        wanted = None if columns is None else {*columns, BATCH_COL, *([self.keep] if self.keep else [])}
        merge = self._mostly_single if few_repeats else self._merged
        latest = merge(raw, [c for c in raw.columns if c not in hidden and (wanted is None or c in wanted)])
        if self.keep:
            latest = latest.where(F.col(self.keep)).drop(self.keep)
        return latest

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Fold every version up to batch ``upto``, repairs too, into one base (one row per key), in passes by the key.

        The base is written to a new folder ``<path>_base/v<upto>`` and only
        then made current, so readers never see a half-written base and a
        replayed batch folder can never clobber it.  ``upto`` should be a
        batch whose sink write has committed (e.g. ``lastProgress.batchId``).
        """
        repairs = self._read_if_there(spark, f"{self.path}_repair")
        folded = [] if repairs is None else [(r[0], r[1]) for r in repairs.select(JOB_COL, REPAIR_COL).distinct().collect()]
        raw = self.raw(spark).where(F.col(BATCH_COL) <= upto)
        with shuffles_removed(spark):
            for k, part in enumerate(in_passes(raw, self.key, passes_for(raw.count()))):
                merged = self._merged(part, [c for c in raw.columns if c not in (BATCH_COL, REPAIR_COL, JOB_COL, BUCKET_COL)])
                self._save(merged, f"{self.path}_base/v{int(upto)}", k > 0)
        self._make_current(spark, upto, folded)
