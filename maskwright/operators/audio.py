"""Spans to finished recordings: neighbours' bounds, silence, tones. A recording is one row, as it is one file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import media
from . import speech


def bounded(spans: DataFrame, ws: DataFrame) -> DataFrame:
    """Spans (file, start, end, reason, heard) with lo and hi, how far they may grow; spans of files without words are free."""
    edges = spans.select("file", "start", "end").distinct()
    return spans.join(speech.neighbour_bounds(edges, ws), ["file", "start", "end"], "left").fillna({"lo": 0.0, "hi": 1e9})


def finished(recordings: DataFrame, spans: DataFrame, ws: DataFrame) -> DataFrame:
    """Recordings (file, sr, samples) that have spans, with tones in their place: file, sr, samples, spans (as grown and merged, with where they began), seconds of tones.

    Spans of a file that isn't there are left out, and a file without words has its spans grown to silence alone. Spark takes an array for one element where it guesses sizes,
    so the join names its way: recordings are never sent to the driver for a broadcast, and stream past the spans of their partition without a sort.
    """
    planned = bounded(spans, ws).groupBy("file").agg(F.array_sort(F.collect_list(F.struct("start", "end", "reason", "heard", "lo", "hi"))).alias("_planned"))
    done = recordings.join(planned.hint("shuffle_hash"), "file").select("file", "sr", media.replaced_by_tones("sr", "samples", "_planned").alias("_d"))
    return done.select("file", "sr", "_d.samples", "_d.spans", "_d.seconds")


def final_spans(done: DataFrame) -> DataFrame:
    return done.select("file", F.inline("spans"))


def wav_files(done: DataFrame) -> DataFrame:
    """path, content of each finished recording."""
    return done.select(F.col("file").alias("path"), media.wav_file("sr", "samples").alias("content"))


def frame_levels(frames: DataFrame, value: str, *by: str) -> DataFrame:
    """Level in decibels of frames of samples, one sample a row; grouped by `by`."""
    v = F.col(value).cast("double")
    return frames.groupBy(*by).agg(F.round(20 * F.log10(F.sqrt(F.avg(v * v)) / 32768 + 1e-12), 6).alias("db"))


def unconfirmed_tones(done: DataFrame, least: float = 0.5) -> DataFrame:
    """Final spans in which the tone isn't heard, by its share of the power; a sound check beside the transcript's."""
    own = done.select("file", "sr", "samples", F.inline("spans"))
    first = F.floor(F.col("start") * F.col("sr"))
    part = F.slice("samples", (first + 1).cast("int"), F.greatest(F.lit(0), F.floor(F.col("end") * F.col("sr")) - first).cast("int"))
    return own.select("file", "start", "end", media.tone_share("sr", part).alias("share")).filter(F.col("share") < least)
