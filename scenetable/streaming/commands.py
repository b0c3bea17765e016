"""Event-shaped pieces on Structured Streaming: command intake, box tracking, the gate board."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.questions import classify_command


def idempotency_key() -> Column:
    """sha256 over requester, kind and target: the same command has the same key."""
    return F.sha2(F.concat_ws("\u0001", "requester", "kind", F.coalesce("target", F.lit(""))), 256)


def plan_commands(commands: DataFrame, manifest: DataFrame) -> DataFrame:
    """Plan rows for commands (request_id, requester, text, target, expected_sha, submitted_at) against manifest (target, manifest_sha).

    Reads go back at once; a stale digest or an unknown target blocks. Works on batches and on streams.
    """
    rows = commands.withColumn("kind", classify_command(F.col("text"))).withColumn("idempotency_key", idempotency_key())
    rows = rows.join(manifest, "target", "left")
    status = (
        F.when(F.col("kind") == "query", "returned")
        .when(F.col("manifest_sha").isNull(), "blocked_unknown_target")
        .when(F.col("manifest_sha") != F.col("expected_sha"), "blocked_stale_manifest")
        .otherwise("queued")
    )
    return rows.withColumns({"status": status, "plan_id": F.substring("idempotency_key", 1, 20), "confirmation": F.concat(F.lit("confirm "), F.substring("idempotency_key", 1, 12))})


def enqueue_once(planned: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """The first of each idempotency key; on a stream within the watermark on submitted_at."""
    if planned.isStreaming:
        return planned.withWatermark("submitted_at", delay).dropDuplicatesWithinWatermark(["idempotency_key"])
    first = planned.groupBy("idempotency_key").agg(F.min_by("request_id", F.struct("submitted_at", "request_id")).alias("request_id"))
    return planned.join(first, ["idempotency_key", "request_id"], "left_semi")


_BOX = "last_seq long, bx double, by double, bw double, bh double"


def track_boxes(boxes: DataFrame, max_cost: float = 1.0) -> DataFrame:
    """Follow one box for each track: of the boxes (track, seq, box_id, bx, by, bw, bh) of a frame the cheapest after the last one.

    Cost: centre shift over the last diagonal + 0.25 |log size change|. A frame no later than the last is
    "late", one without a box under `max_cost` is "lost" and leaves the state. Runs on streams and batches.
    """
    kind = dict(boxes.dtypes)["track"]
    schema = f"track {kind}, seq long, box_id long, cost double, status string"

    def follow(track, boxes_: pd.DataFrame, last: tuple | None) -> tuple[pd.DataFrame, tuple | None]:
        out = []
        for seq, frame in boxes_.sort_values(["seq", "box_id"]).groupby("seq"):
            if last is not None and seq <= last[0]:
                out.append((track, int(seq), None, None, "late"))
                continue
            cost, best = 0.0, next(frame.itertuples())
            if last is not None:
                cost, best = min(((_cost(r, last), r) for r in frame.itertuples()), key=lambda c: (c[0], c[1].box_id))
            if cost > max_cost:
                out.append((track, int(seq), None, float(cost), "lost"))
                continue
            last = (int(seq), float(best.bx), float(best.by), float(best.bw), float(best.bh))
            out.append((track, int(seq), int(best.box_id), float(cost), "tracked"))
        return pd.DataFrame(out, columns=["track", "seq", "box_id", "cost", "status"]).astype({"box_id": "Int64"}), last

    if not boxes.isStreaming:
        return boxes.groupBy("track").applyInPandas(lambda key, pdf: follow(key[0], pdf, None)[0], schema)

    def step(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out, last = follow(key[0], pd.concat(list(pdfs)), state.get if state.exists else None)
        if last is not None:
            state.update(last)
        yield out

    return boxes.groupBy("track").applyInPandasWithState(step, schema, _BOX, "append", GroupStateTimeout.NoTimeout)


def _cost(box, last: tuple) -> float:
    """Of a box after the last one (seq, x, y, width, height)."""
    return math.hypot(box.bx - last[1], box.by - last[2]) / math.hypot(last[3], last[4]) + 0.25 * abs(math.log(box.bw * box.bh / (last[3] * last[4])))


def gate_board(reports: DataFrame, delay: str | None = None) -> DataFrame:
    """The latest status of each object and gate from reports (object_id, gate, status, ts)."""
    rows = reports.withWatermark("ts", delay) if delay and reports.isStreaming else reports
    return rows.groupBy("object_id", "gate").agg(F.max_by("status", F.struct("ts", "status")).alias("status"), F.max("ts").alias("ts"))
