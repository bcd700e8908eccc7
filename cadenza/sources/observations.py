"""Where decoding and inference plug in: functions from batches to observation rows, run on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


class Decoder(Protocol):
    """A source of frames: batches of at most n frames in order, and the end."""

    def get_batch_frames(self, n: int) -> list: ...

    def end(self) -> None: ...


_SCALARS = ("face_score", "pose_score", "head_pitch_deg", "head_yaw_deg", "head_roll_deg", "head_pose_rigidity_error", "eye_horizontal", "eye_vertical")
OBSERVATION = T.StructType(
    [T.StructField("source_id", T.StringType()), T.StructField("frame", T.IntegerType())]
    + [T.StructField(n, T.BooleanType()) for n in ("face_detected", "pose_detected")]
    + [T.StructField(n, T.DoubleType()) for n in _SCALARS]
    + [T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("face_landmarks", "pose_landmarks")]
)


def observe(frames: DataFrame, infer: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType = OBSERVATION) -> DataFrame:
    """Observations of frames by an injected function of a batch; it is sent to the executors and called once for each batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield infer(batch)[schema.fieldNames()]

    return frames.mapInPandas(run, schema)


def decoded(sources: DataFrame, open_source: Callable[[str], Decoder], infer: Callable[[list], list[dict]], batch: int = 32, schema: T.StructType = OBSERVATION) -> DataFrame:
    """Observations of whole sources (source_id, path): each is decoded and inferred batch by batch, in one task. A short batch is the last."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for source_id, path in zip(part["source_id"], part["path"], strict=True):
                decoder, frame = open_source(path), 0
                try:
                    while images := decoder.get_batch_frames(batch):
                        rows = infer(images)
                        if len(rows) != len(images):
                            raise ValueError(f"{source_id}: {len(images)} frames gave {len(rows)} observations")
                        out = pd.DataFrame([{"source_id": source_id, "frame": frame + k, **r} for k, r in enumerate(rows)])
                        frame += len(rows)
                        yield out.reindex(columns=schema.fieldNames())
                finally:
                    decoder.end()

    return sources.mapInPandas(run, schema)
