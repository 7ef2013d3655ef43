"""The feeds that can be read, and choosing among them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The public subway endpoints, one per group of lines.
_ENDPOINT = "https://api-endpoint.mta.info/Dataservice/mtagtfsfeeds/"
FEEDS = {
    "1234567S": _ENDPOINT + "nyct%2Fgtfs",
    "ACE": _ENDPOINT + "nyct%2Fgtfs-ace",
    "BDFM": _ENDPOINT + "nyct%2Fgtfs-bdfm",
    "G": _ENDPOINT + "nyct%2Fgtfs-g",
    "JZ": _ENDPOINT + "nyct%2Fgtfs-jz",
    "NQRW": _ENDPOINT + "nyct%2Fgtfs-nqrw",
    "L": _ENDPOINT + "nyct%2Fgtfs-l",
    "SIR": _ENDPOINT + "nyct%2Fgtfs-si",
}
DEFAULT_FEEDS = ("1234567S",)


def resolve_feeds(
    selection: str | None = None,
    catalogue: Mapping[str, str] = FEEDS,
    default: tuple[str, ...] = DEFAULT_FEEDS,
) -> dict[str, str]:
    """``all``, a comma list of keys, or nothing for the default feeds."""
    text = (selection or "").strip()
    if text.lower() == "all":
        wanted = list(catalogue)
    else:
        wanted = [key for key in (part.strip() for part in text.split(",")) if key]
        wanted = wanted if text else list(default)
    unknown = sorted(set(wanted) - set(catalogue))
    if unknown:
        raise ValueError(f"unknown feeds {unknown}; known are {list(catalogue)} or 'all'")
    return {key: catalogue[key] for key in wanted}


def select_feeds(
    df: DataFrame, selection: str | None = None, catalogue: Mapping[str, str] = FEEDS, **kwargs
) -> DataFrame:
    """Rows of the chosen feeds. On a landed table this prunes ``feed_key`` folders."""
    return df.filter(F.col("feed_key").isin(*resolve_feeds(selection, catalogue, **kwargs)))


def feed_url(feed_key: Column, catalogue: Mapping[str, str] = FEEDS) -> Column:
    url = F.lit(None).cast("string")
    for key, address in catalogue.items():
        url = F.when(feed_key == key, address).otherwise(url)
    return url
