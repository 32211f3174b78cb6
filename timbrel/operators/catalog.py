"""Catalogue building: flatten payloads, supplement, de-duplicate, cap, summarise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbrel.functions.names import join_names
from timbrel.operators.positions import first_per_key, top_per_group
from timbrel.schemas import RECOMMENDATION_PAYLOAD, SEARCH_PAYLOAD


def _tracks(df: DataFrame, items: Column, *keep: str) -> DataFrame:
    rows = df.select(*keep, F.posexplode(items).alias("position", "_item"))
    return rows.select(
        *keep,
        "position",
        F.col("_item.id").alias("track_id"),
        F.col("_item.name").alias("track_name"),
        join_names(F.col("_item.artists")).alias("artists"),
        F.col("_item.album.name").alias("album"),
        "_item.popularity",
        "_item.duration_ms",
        "_item.preview_url",
    )


def flatten_search(df: DataFrame, payload: str, *keep: str) -> DataFrame:
    """One row per track of a search answer (``tracks.items[]``)."""
    return _tracks(df, F.from_json(payload, SEARCH_PAYLOAD)["tracks"]["items"], *keep)


def flatten_recommendations(df: DataFrame, payload: str, *keep: str) -> DataFrame:
    """One row per track of a recommendation answer (``tracks[]``)."""
    return _tracks(df, F.from_json(payload, RECOMMENDATION_PAYLOAD)["tracks"], *keep)


def supplement(primary: DataFrame, fallback: DataFrame, n: int, group: str, *position: str) -> DataFrame:
    """Up to ``n`` rows per group, primary first, filled up from the fallback."""
    both = primary.withColumn("_source", F.lit(0)).unionByName(fallback.withColumn("_source", F.lit(1)))
    return top_per_group(both, n, [group], "_source", *position)


def build_catalog(
    primary: DataFrame,
    fallback: DataFrame,
    genres: DataFrame,
    n: int = 50,
    key: str = "track_id",
    position: tuple[str, ...] = ("page", "position"),
) -> DataFrame:
    """Tracks of every genre: supplement, tag with ``target_genre``, first wins, cap.

    ``genres`` has ``genre, target_genre, genre_pos``; ``position`` orders the
    tracks of one genre and source without ties. Supplementing comes
    first and leaves at most ``n`` rows per genre, so the de-duplication and
    the cap work on a small table whatever the size of the inputs.
    """
    drawn = supplement(primary, fallback, n, "genre", *position)
    tagged = drawn.join(genres, "genre")
    unique = first_per_key(tagged, key, "genre_pos", "_source", *position)
    capped = top_per_group(unique, n, ["target_genre"], "_source", *position)
    return capped.drop("_source")


def _two_decimals(value: Column) -> Column:
    """Rounded as numpy rounds: scaled, to the nearest even integer, scaled back."""
    return F.rint(value * 100) / 100


def genre_summary(df: DataFrame, genre: str = "genre") -> DataFrame:
    """Track count, mean popularity and mean minutes per genre, two decimals."""
    return df.groupBy(genre).agg(
        F.count("track_id").alias("track_count"),
        _two_decimals(F.avg("popularity")).alias("avg_popularity"),
        _two_decimals(F.avg("duration_ms") / 60000).alias("avg_duration_min"),
    )


def catalog_totals(df: DataFrame, genre: str = "genre") -> DataFrame:
    """Total rows and distinct genres, from one pre-aggregated pass."""
    return (
        df.groupBy(genre)
        .count()
        .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total_tracks"), F.count(genre).alias("unique_genres"))
    )
