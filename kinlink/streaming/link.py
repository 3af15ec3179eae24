"""Linking a stream of target records to standing references.

References are standing: their capped postings are a static table. Each
micro-batch of raw target records is joined to them, and the batch's candidates
are merged into the best ``k`` of every reference. The order (rank, id) is
total for unique ids, so the merge does not depend on how the stream is cut
into batches and equals one batch run over all targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import blocking, records


class LinkStream:
    """Holds the current best candidates as a versioned table in ``path``.

    The versions are those found in the folder, so a stream that is started
    again goes on from the last one. All but the newest ``keep`` are deleted.
    """

    def __init__(self, refs: DataFrame, path: str, k: int = 12, cap: int = 64, keep: int = 3):
        if keep < 2:
            raise ValueError("a repeated batch needs the version before its own")
        self.refs, self.path, self.k, self.keep = refs, path, k, keep
        self.postings = blocking.capped_postings(blocking.hashed(blocking.blocking_keys(refs)), cap)

    def _folder(self):
        spark = self.refs.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path, path.getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """The batches whose version is written whole, in order."""
        path, fs = self._folder()
        if not fs.exists(path):
            return []
        done = [f.getPath().getName() for f in fs.listStatus(path) if fs.exists(f.getPath().suffix("/_SUCCESS"))]
        return sorted(int(name[1:]) for name in done if name.startswith("v") and name[1:].isdigit())

    def best(self, before: int | None = None) -> DataFrame | None:
        """The newest version, or the newest of a batch earlier than ``before``."""
        known = [v for v in self.versions() if before is None or v < before]
        return self.refs.sparkSession.read.parquet(f"{self.path}/v{max(known)}") if known else None

    def merge(self, raw: DataFrame, batch: int) -> None:
        """Called once per micro-batch; a repeated batch writes its version again, from the one before."""
        targets = records.prepare_records(records.normalize_records(raw))
        hits = blocking.candidate_hits(self.postings, blocking.hashed(blocking.blocking_keys(targets)))
        pairs = blocking.plausible_pairs(hits, self.refs, targets)
        if (held := self.best(before=batch)) is not None:
            pairs = held.unionByName(pairs)
        once = blocking.best_of_each_pair(pairs)  # a target may come again, in this batch or a later one
        blocking.top_candidates(once, self.k).write.mode("overwrite").parquet(f"{self.path}/v{batch}")
        path, fs = self._folder()
        for old in [v for v in self.versions() if v <= batch][: -self.keep]:
            fs.delete(path.suffix(f"/v{old}"), True)

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.merge).option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start()
