"""Chains of landed pages, each naming the token of the next one.

Pages land in any order, some more than once and some not at all. Their place
is found by pointer doubling: every page points to the next one, and each round
lets it point to where that one points, so a chain of n pages takes log2(n)
rounds of one join and no task ever follows a chain.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge import schemas
from reelgauge.session import settle
from reelgauge.sources.readers import parse_json

#: Token of a request without one: the first page.
START = ""


def next_tokens(pages: DataFrame, text: str = "page") -> DataFrame:
    """``pages`` with ``next``, the token a page held as JSON text names; none on the last page."""
    return pages.withColumn("next", parse_json(F.col(text), schemas.PLAYLIST_PAGE)["nextPageToken"])


def chains(pages: DataFrame, chain: str = "playlist", token: str = "token") -> DataFrame:
    """One row per page of a chain, from rows of ``chain``, ``token`` and ``next``.

    ``copies`` counts repeats; if they name different next pages the smallest
    token counts. ``position`` is the number of pages before it in its segment,
    a run of pages that follow each other, and ``status`` tells of the segment:
    "complete" from the first page to the last, "cut" from the first page to
    one whose next page is missing (``missing`` is that token), "orphan" if its
    own first page follows a missing one, "loop" if its pages lead back to one
    of them; a loop has no position. Rows without chain are left out.
    """
    page = [chain, token]
    known = settle(
        pages.filter(F.col(chain).isNotNull())
        .select(chain, F.coalesce(token, F.lit(START)).alias(token), "next")
        .groupBy(*page, "next")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*page)
        .agg(F.sum("n").alias("copies"), F.min("next").alias("next")),
        "pages",
    )
    there = known.select(chain, F.col(token).alias("next"), F.lit(True).alias("there"))
    linked = known.join(there, [chain, "next"], "left")
    # Where a page points, in how many steps, and whether that is an end.
    moves = F.coalesce("there", F.lit(False))
    state = settle(
        linked.select(
            *page,
            F.when(moves, F.col("next")).otherwise(F.col(token)).alias("at"),
            moves.cast("long").alias("steps"),
            (~moves).alias("ended"),
        ),
        "chains",
    )
    longest = known.groupBy(chain).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    for _ in range(ceil(log2(longest)) + 1):
        moving = state.filter(~F.col("ended"))
        if moving.isEmpty():
            break
        ahead = state.select(
            chain,
            F.col(token).alias("at"),
            F.col("at").alias("_at"),
            F.col("steps").alias("_steps"),
            F.col("ended").alias("_ended"),
        )
        moved = moving.join(ahead, [chain, "at"]).select(
            *page, F.col("_at").alias("at"), (F.col("steps") + F.col("_steps")).alias("steps"), F.col("_ended").alias("ended")
        )
        state = settle(state.filter("ended").unionByName(moved), "chains")
    ends = known.select(chain, F.col(token).alias("at"), F.col("next").alias("missing"))
    segments = settle(
        state.filter("ended")
        .groupBy(chain, "at")
        .agg(F.max("steps").alias("length"), F.bool_or(F.col(token) == START).alias("begun"))
        .join(ends, [chain, "at"]),
        "segments",
    )
    status = F.when(F.col("begun") & F.col("missing").isNull(), "complete").when(F.col("begun"), "cut").otherwise("orphan")
    return (
        known.join(state.filter("ended"), page, "left")
        .join(segments, [chain, "at"], "left")
        .select(
            *page,
            "next",
            "copies",
            (F.col("length") - F.col("steps")).alias("position"),
            F.when(F.col("ended"), status).otherwise("loop").alias("status"),
            "missing",
        )
    )
