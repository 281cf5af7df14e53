"""The order of pages that know only the token of the page after them.

A search answers with its issues and the token of the next page; what it was
asked with is landed beside it (null for the first page). The pages of a run
are therefore a linked list, and its order is found by pointer jumping: in
round k every page knows the page 2**k steps on, and the pages ranked so far
hand their rank plus 2**k to it. A chain of n pages is ranked in log2(n)
rounds of two joins on unique (chain, token) keys; payloads take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaprecon.session import cut

#: what a chain can come to
WHOLE, BROKEN, CYCLIC, HEADLESS = "whole", "broken", "cyclic", "headless"


def _key(token: str) -> Column:
    """The key of a page by the token it was asked with: the first page (null or empty token) and every token have their own."""
    return F.coalesce(F.concat(F.lit("="), F.when(F.col(token) != "", F.col(token))), F.lit("-"))


def rank_pages(pages: DataFrame, chain: str, asked: str, following: str, ends: Column, arrival: Column) -> DataFrame:
    """Every page's (chain, token key ``page``, ``arrival``, ``position``, ``state``), one row per landed page.

    ``asked`` is the token a page was asked with, ``following`` the one it
    names. A chain starts at the page without ``asked`` and goes on until a
    page for which ``ends`` holds or that names no token. state: ``in order``
    (position from 0), ``repeated`` (the same page landed again later; the
    last arrival counts) or ``orphan`` (not on the way from the first page:
    after the end, behind a gap, or part of a list of its own).
    """
    on = F.when(~F.coalesce(ends, F.lit(False)) & (F.col(following) != ""), F.concat(F.lit("="), F.col(following)))
    landed = cut(pages.select(F.col(chain).alias("chain"), _key(asked).alias("page"), on.alias("next"), arrival.alias("arrival")))
    last = landed.groupBy("chain", "page").agg(F.max(F.struct("arrival", "next")).alias("best"))
    nodes = last.select("chain", "page", F.col("best.arrival").alias("arrival"), F.col("best.next").alias("next"))
    jump = cut(nodes.where("next is not null").select("chain", "page", "next"))
    ranked = cut(nodes.where("page = '-'").select("chain", "page", F.lit(0).cast("bigint").alias("position")))
    known, reach = ranked.count(), 1
    while True:
        exists = nodes.select("chain", F.col("page").alias("next"))
        ahead = ranked.join(jump, ["chain", "page"]).join(exists, ["chain", "next"]).select("chain", F.col("next").alias("page"), (F.col("position") + reach).alias("position"))
        # a page on a cycle is met again, farther on: its first place counts
        ranked = cut(ranked.unionByName(ahead).groupBy("chain", "page").agg(F.min("position").alias("position")))
        now = ranked.count()
        if now == known:
            break
        known, reach = now, 2 * reach
        beyond = jump.select("chain", F.col("page").alias("next"), F.col("next").alias("then"))
        jump = cut(jump.join(beyond, ["chain", "next"]).select("chain", "page", F.col("then").alias("next")))
    same = landed.join(nodes.select("chain", "page", F.col("arrival").alias("last")), ["chain", "page"]).join(ranked, ["chain", "page"], "left")
    state = F.when(F.col("arrival") < F.col("last"), "repeated").when(F.col("position").isNull(), "orphan").otherwise("in order")
    return same.select("chain", "page", "next", "arrival", F.when(state == "in order", F.col("position")).alias("position"), state.alias("state"))


def chain_report(ranked: DataFrame) -> DataFrame:
    """One row per chain: its state, and its pages in order, orphaned and repeated.

    ``whole``: the way from the first page comes to an end; ``broken``: its
    last page names one that was not landed; ``cyclic``: it comes back to
    itself; ``headless``: no first page.
    """
    by = ranked.groupBy("chain").agg(
        *[F.count_if(F.col("state") == s).alias(n) for s, n in (("in order", "n_pages"), ("orphan", "n_orphans"), ("repeated", "n_repeated"))],
        F.max(F.when(F.col("state") == "in order", F.struct("position", "next"))).alias("last"),
    )
    back = ranked.where(F.col("state") == "in order").select(F.col("chain").alias("__chain"), F.col("page").alias("__page"))
    joined = by.join(back, (F.col("chain") == F.col("__chain")) & (F.col("last.next") == F.col("__page")), "left")
    state = (
        F.when(F.col("last").isNull(), HEADLESS)
        .when(F.col("last.next").isNull(), WHOLE)
        .when(F.col("__page").isNotNull(), CYCLIC)
        .otherwise(BROKEN)
    )
    return joined.select("chain", state.alias("chain_state"), "n_pages", "n_orphans", "n_repeated")


def in_order(pages: DataFrame, ranked: DataFrame, chain: str, asked: str, arrival: Column) -> DataFrame:
    """``pages`` with their ``position``, those in order only: the payloads move once, by their key."""
    keyed = pages.withColumn("__page", _key(asked)).withColumn("__arrival", arrival)
    right = ranked.where(F.col("state") == "in order").select(F.col("chain").alias("__chain"), F.col("page").alias("__p"), F.col("arrival").alias("__a"), "position")
    same = (F.col(chain) == F.col("__chain")) & (F.col("__page") == F.col("__p")) & (F.col("__arrival") == F.col("__a"))
    return keyed.join(right, same).drop("__page", "__arrival", "__chain", "__p", "__a")
