"""Flow tables, training shards, and their metadata."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.flows import csv_rows

#: Number types of shard arrays.
ARRAYS = {
    "packet_tokens": "f4", "flow_tokens": "f4", "endpoint_tokens": "f4", "service_tokens": "f4", "edge_tokens": "f4", "graph_tokens": "f4", "packet_masks": "u1",
    "labels": "i4", "segment_labels": "i4", "flow_key_hashes": "u8", "cutoff_timestamp_ns": "i8", "prefix_lens": "i2", "protocols": "i2", "dst_ports": "i4",
    "length_buckets": "i2", "service_buckets": "u8", "source_ids": "i2", "segment_ids": "i4",
}


def write_flow_csv(features: DataFrame, path: str) -> None:
    """The 18 columns of a flow CSV, with a header, as a folder of parts."""
    csv_rows(features).write.mode("overwrite").option("header", True).csv(path)


def emptied(path: str) -> None:
    """An output folder, new and empty."""
    shutil.rmtree(path, ignore_errors=True)
    os.makedirs(path)


def write_shards(encoded: DataFrame, path: str, shard_flows: int, digits: int = 6) -> list[dict]:
    """NumPy shards of so many rows each under a folder that all executors share; returns name, label_counts and, if rows have a source, source_counts of each.

    A shard's rows, which are bounded, are written by one task, whole and then renamed.
    """
    names = {"source_id": "source_ids", "segment_id": "segment_ids"}
    rows = encoded.withColumn("shard_id", F.floor(F.col("emit_seq") / shard_flows).cast("bigint"))

    def write(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("emit_seq")
        number = int(shard["shard_id"].iloc[0])
        arrays = {}
        for c in shard.columns:
            if c not in ("emit_seq", "shard_id"):
                kind = ARRAYS[names.get(c, c)]
                values = [np.stack([np.asarray(r) for r in v]) if len(v) and hasattr(v[0], "__len__") else v for v in shard[c]] if shard[c].dtype == object else shard[c].to_numpy()
                arrays[names.get(c, c)] = np.asarray(values).astype("i8").view("u8") if kind == "u8" else np.asarray(values).astype(kind)
        name = f"shard_{number:0{digits}d}.npz"
        own = os.path.join(path, f".{name}.{os.getpid()}.npz")
        np.savez(own, **arrays)
        os.replace(own, os.path.join(path, name))
        counts = [json.dumps({str(k): int(n) for k, n in shard[c].value_counts().sort_index().items()}) if c in shard.columns else None for c in ("labels", "source_id")]
        return pd.DataFrame({"shard_id": [number], "name": [name], "labels": counts[:1], "sources": counts[1:]})

    out = rows.groupBy("shard_id").applyInPandas(write, "shard_id bigint, name string, labels string, sources string").orderBy("shard_id")
    return [{"name": r.name, "label_counts": json.loads(r.labels)} | ({"source_counts": json.loads(r.sources)} if r.sources else {}) for r in out.select("name", "labels", "sources").toLocalIterator()]


def write_metadata(path: str, metadata: dict) -> None:
    """The same text as metadata.json and meta.json."""
    for name in ("metadata.json", "meta.json"):
        with open(os.path.join(path, name), "w") as f:
            json.dump(metadata, f, indent=2)


def read_shard(path: str) -> Iterator[tuple[str, np.ndarray]]:
    with np.load(path) as z:
        yield from ((k, z[k]) for k in z.files)
