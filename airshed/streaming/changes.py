"""Change feed fold on a stream (S19, streaming form).

The state is a log of layers, each split into buckets by a hash of the key. A
micro-batch folds its own rows to the latest per key and writes them as
the layer ``delta/batch_id=N``: the work is that of the batch, whatever the
size of the state. When ``compact_every`` of them have gathered they are folded
bucket by bucket, together with those older layers of the bucket that are
not much larger than what is folded into them (``GROWTH``). So a row is
rewritten a number of times that grows with the logarithm of the state,
buckets without changes are not touched, and a bucket has as many layers
at most. Folding is associative: any grouping of the layers gives the same state.

A batch counts once its ``_SUCCESS`` marker exists, a compaction once the
marker that lists the layers of every bucket does. A replayed batch
rewrites its own folder, a layer is removed only after a committed list is
without it: a failure at any point leaves a complete state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airshed.operators.changes import apply_changes
from airshed.sources.versions import commit, commits, facts_of, file_system

COMPACT_EVERY, BUCKETS, GROWTH = 16, 8, 2
_BUCKET = "_bucket"


def _deltas(spark: SparkSession, state_path: str) -> list[tuple[int, str]]:
    """(batch, path) of the committed batches, oldest first (a listing)."""
    fs, root = file_system(spark, f"{state_path}/delta")
    if not fs.exists(root):
        return []
    found = []
    for st in fs.listStatus(root):
        name, success = st.getPath().getName(), file_system(spark, f"{st.getPath()}/_SUCCESS")[1]
        if st.isDirectory() and "=" in name and fs.exists(success):
            found.append((int(name.split("=", 1)[1]), f"{state_path}/delta/{name}"))
    return sorted(found)


def _bucket_sizes(spark: SparkSession, folder: str) -> dict[str, int]:
    """Bytes of each bucket of a layer."""
    fs, root = file_system(spark, folder)
    return {st.getPath().getName().split("=", 1)[1]: int(fs.getContentSummary(st.getPath()).getLength())
            for st in fs.listStatus(root) if st.isDirectory()}


def _base(spark: SparkSession, state_path: str) -> tuple[int, dict[str, list[list]]]:
    """The last batch that is folded into the base (-1: none), and the layers
    [name, bytes] of each bucket, oldest first."""
    done = commits(spark, state_path)
    return (int(done[-1]), facts_of(spark, state_path, done[-1])["layers"]) if done else (-1, {})


def _live_layers(spark: SparkSession, state_path: str) -> tuple[int, list[str]]:
    """The base's last batch and the paths the state is made of."""
    upto, layers = _base(spark, state_path)
    paths = [f"{state_path}/base/{name}/{_BUCKET}={b}" for b, of in layers.items() for name, _ in of]
    # a batch without rows has no bucket
    return upto, paths + [p for n, p in _deltas(spark, state_path) if n > upto and _bucket_sizes(spark, p)]


def _fold(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], op_col: str) -> DataFrame:
    # deletes stay in the layers: an older change may still arrive
    return apply_changes(df, keys, order_cols, op_col=op_col, delete_ops=()).select(*df.columns)


def _write_layer(df: DataFrame, keys: Sequence[str], path: str, buckets: int) -> None:
    """By buckets of the key; a bucket of a layer is one task's, unless it is large."""
    bucket = F.pmod(F.xxhash64(*(F.col(k).cast("string") for k in keys)), F.lit(buckets)).cast("int")
    df.withColumn(_BUCKET, bucket).hint("rebalance", _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(path)


def fold_batch(batch: DataFrame, batch_id: int, keys: Sequence[str], order_cols: Sequence[str],
               state_path: str, op_col: str = "op", compact_every: int = COMPACT_EVERY, buckets: int = BUCKETS) -> None:
    """Write one micro-batch as a layer (idempotent per batch id); compact
    when ``compact_every`` batches have gathered. ``buckets`` is fixed for a state."""
    spark = batch.sparkSession
    upto, _ = _base(spark, state_path)
    if batch_id <= upto:
        return  # a replay of a batch that a base already holds
    _write_layer(_fold(batch, keys, order_cols, op_col), keys, f"{state_path}/delta/batch_id={batch_id}", buckets)
    if sum(n > upto for n, _ in _deltas(spark, state_path)) > compact_every:
        compact(spark, state_path, keys, order_cols, op_col, buckets)


def compact(spark: SparkSession, state_path: str, keys: Sequence[str], order_cols: Sequence[str],
            op_col: str = "op", buckets: int = BUCKETS) -> int:
    """Fold the gathered batches into the base; returns the bytes read for it."""
    upto, layers = _base(spark, state_path)
    deltas = [(n, p) for n, p in _deltas(spark, state_path) if n > upto]
    if not deltas:
        return 0
    last, read, paths = deltas[-1][0], 0, []
    size: dict[str, int] = {}
    for _, path in deltas:
        for b, n in _bucket_sizes(spark, path).items():
            size[b] = size.get(b, 0) + n
            paths.append(f"{path}/{_BUCKET}={b}")
    for b, n in size.items():
        kept = layers.get(b, [])
        # the newest layers first, while they are not much larger than what is merged already
        while kept and kept[-1][1] <= GROWTH * n:
            name, old = kept.pop()
            paths.append(f"{state_path}/base/{name}/{_BUCKET}={b}")
            n += old
        read += n
    name = f"upto={last}"
    if paths:
        _write_layer(_fold(_read(spark, paths), keys, order_cols, op_col), keys, f"{state_path}/base/{name}", buckets)
        for b, n in _bucket_sizes(spark, f"{state_path}/base/{name}").items():
            layers.setdefault(b, []).append([name, n])
    commit(spark, state_path, f"{last:012d}", {"layers": layers}, replace=True)
    _remove_dead(spark, state_path, last, layers)
    return read


def _remove_dead(spark: SparkSession, state_path: str, upto: int, layers: dict[str, list[list]]) -> None:
    """Batches and buckets of layers that the committed list is without."""
    fs, base = file_system(spark, f"{state_path}/base")
    for n, path in _deltas(spark, state_path):
        if n <= upto:
            fs.delete(file_system(spark, path)[1], True)
    if not fs.exists(base):
        return
    live = {(name, b) for b, of in layers.items() for name, _ in of}
    for st in fs.listStatus(base):
        name = st.getPath().getName()
        if not any(name == n for n, _ in live):
            fs.delete(st.getPath(), True)
            continue
        for b in _bucket_sizes(spark, f"{state_path}/base/{name}"):
            if (name, b) not in live:
                fs.delete(file_system(spark, f"{state_path}/base/{name}/{_BUCKET}={b}")[1], True)


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    # one reader for all layers; their folder names are no columns
    return spark.read.option("recursiveFileLookup", "true").parquet(*paths)


def fold_changes_stream(stream: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                        state_path: str, checkpoint: str, op_col: str = "op",
                        trigger: dict | None = None, compact_every: int = COMPACT_EVERY,
                        buckets: int = BUCKETS) -> StreamingQuery:
    def merge(batch: DataFrame, batch_id: int) -> None:
        fold_batch(batch, batch_id, keys, order_cols, state_path, op_col, compact_every, buckets)

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
                  .trigger(**(trigger or {"availableNow": True})).start())


def current_state(spark: SparkSession, state_path: str, keys: Sequence[str], order_cols: Sequence[str],
                  op_col: str = "op", delete_ops: Sequence[str] = ("d",)) -> DataFrame:
    """Live rows of the state (deletes removed)."""
    _, paths = _live_layers(spark, state_path)
    if not paths:
        raise FileNotFoundError(f"no committed state under {state_path}")
    return apply_changes(_read(spark, paths), keys, order_cols, op_col=op_col, delete_ops=delete_ops)
