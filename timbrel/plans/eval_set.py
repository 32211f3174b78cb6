"""Evaluation set: genre matching, payload tables, first-wins catalogue, export, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timbrel.operators.catalog import (
    build_catalog,
    catalog_totals,
    flatten_recommendations,
    flatten_search,
    genre_summary,
)
from timbrel.operators.matching import match_keys
from timbrel.sinks.tables import export_catalog

# The genres an evaluation set covers, in order.
TARGET_GENRES = (
    "rock", "pop", "hip-hop", "jazz", "classical", "electronic", "r-n-b", "country", "metal", "folk",
    "blues", "reggae", "latin", "indie", "soul", "funk", "punk", "ambient", "acoustic", "piano",
)
SONGS_PER_GENRE = 50

# The genres known to the catalogue when it cannot be asked, in order.
KNOWN_GENRES = (
    "acoustic", "afrobeat", "alt-rock", "alternative", "ambient", "anime", "black-metal", "bluegrass",
    "blues", "bossanova", "brazil", "breakbeat", "british", "cantopop", "chicago-house", "children", "chill",
    "classical", "club", "comedy", "country", "dance", "dancehall", "death-metal", "deep-house",
    "detroit-techno", "disco", "disney", "drum-and-bass", "dub", "dubstep", "edm", "electro", "electronic",
    "emo", "folk", "forro", "french", "funk", "garage", "german", "gospel", "goth", "grindcore", "groove",
    "grunge", "guitar", "happy", "hard-rock", "hardcore", "hardstyle", "heavy-metal", "hip-hop", "holidays",
    "honky-tonk", "house", "idm", "indian", "indie", "indie-pop", "industrial", "iranian", "j-dance",
    "j-idol", "j-pop", "j-rock", "jazz", "k-pop", "kids", "latin", "latino", "malay", "mandopop", "metal",
    "metal-misc", "metalcore", "minimal-techno", "movies", "mpb", "new-age", "new-release", "opera", "pagode",
    "party", "philippines-opm", "piano", "pop", "pop-film", "post-dubstep", "power-pop", "progressive-house",
    "psych-rock", "punk", "punk-rock", "r-n-b", "rainy-day", "reggae", "reggaeton", "road-trip", "rock",
    "rock-n-roll", "rockabilly", "romance", "sad", "salsa", "samba", "sertanejo", "show-tunes",
    "singer-songwriter", "ska", "sleep", "songwriter", "soul", "soundtracks", "spanish", "study", "summer",
    "swedish", "synth-pop", "tango", "techno", "trance", "trip-hop", "turkish", "work-out", "world-music",
)


def known_genres(spark: SparkSession) -> DataFrame:
    """``name, pos`` of the known genres."""
    return spark.createDataFrame([(g, i) for i, g in enumerate(KNOWN_GENRES)], "name string, pos int")


def target_genres(spark: SparkSession) -> DataFrame:
    """``target, genre_pos`` of the target genres."""
    return spark.createDataFrame([(g, i) for i, g in enumerate(TARGET_GENRES)], "target string, genre_pos int")


def matched_genres(targets: DataFrame, available: DataFrame) -> DataFrame:
    """``target_genre, genre, genre_pos`` of the targets that have a match.

    ``targets`` has ``target, genre_pos``; ``available`` has ``name, pos``.
    """
    matches = match_keys(targets, "target", available, "name", "pos").filter(F.col("match").isNotNull())
    return matches.join(targets, "target").select(
        F.col("target").alias("target_genre"), F.col("match").alias("genre"), "genre_pos"
    )


def build_eval_set(
    searches: DataFrame, recommendations: DataFrame, targets: DataFrame, available: DataFrame, n: int = SONGS_PER_GENRE
) -> DataFrame:
    """Tracks per target genre from payload tables ``(genre, page, payload)``."""
    found = flatten_search(searches, "payload", "genre", "page")
    more = flatten_recommendations(recommendations, "payload", "genre", "page")
    return build_catalog(found, more, matched_genres(targets, available), n)


def export_eval_set(eval_set: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Write CSV and JSON; returns (summary per genre, totals) of what was written."""
    _, json_path = export_catalog(eval_set, folder)
    written = eval_set.sparkSession.read.schema(eval_set.schema).json(json_path)
    return genre_summary(written), catalog_totals(written)
