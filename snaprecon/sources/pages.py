"""Paged search payloads ``{issues: [...], nextPageToken}`` as a table.

Pages are one JSON document per line. Each page is parsed once; the issues
array is exploded with its position, so ``(page, position)`` is the arrival
ordinal keep-last needs. Non-object items are skipped; a page that is not
JSON or has no ``issues`` list goes to the rejects frame with the reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaprecon.functions import variant as vx


def parse_pages(pages: DataFrame, text_col: str = "value") -> DataFrame:
    """The pages (all their columns), each parsed once: broken, page_no, issues, next_token."""
    v = F.col("__v")
    return pages.select("*", F.explode(F.array(F.try_parse_json(F.col(text_col)))).alias("__v")).select(
        *[F.col(f"`{c}`") for c in pages.columns],
        v.isNull().alias("broken"),
        F.try_variant_get(v, "$.page", "bigint").alias("page_no"),
        F.try_variant_get(v, "$.issues", "array<variant>").alias("issues"),
        F.try_variant_get(v, "$.nextPageToken", "string").alias("next_token"),
    )


def until_chain_end(parsed: DataFrame, chain: list[str]) -> DataFrame:
    """The parsed pages up to the end of their chain (columns ``chain``), in page order.

    A chain ends with its first page that has no issue or no next token; what
    was landed after it (an older, longer run, say) does not belong to the
    result. A malformed page ends nothing: it is for the rejects. A chain
    without an end keeps all its pages. One partial aggregate per chain, no
    sort of its pages.
    """
    last = F.col("issues").isNotNull() & ((F.size("issues") == 0) | (F.coalesce("next_token", F.lit("")) == ""))
    ends = parsed.groupBy(*chain).agg(F.min(F.when(last, F.col("page_no"))).alias("__end"))
    ends = ends.select(*[F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(chain)], "__end")
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(chain)]
    kept = parsed.join(ends, same).where(F.col("__end").isNull() | (F.col("page_no") <= F.col("__end")))
    return kept.drop("__end", *[f"__k{i}" for i in range(len(chain))])


def explode_pages(pages: DataFrame, text_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(issues, rejects) of the pages."""
    return explode_parsed(parse_pages(pages, text_col), text_col)


def explode_parsed(parsed: DataFrame, text_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(issues, rejects) of parsed pages."""
    ok = parsed.where(F.col("issues").isNotNull())
    rejects = parsed.where(F.col("issues").isNull()).select(
        text_col, "page_no", F.when(F.col("broken"), "not JSON").otherwise("no issues list").alias("reason")
    )
    items = ok.select("page_no", "next_token", F.posexplode("issues").alias("pos", "issue"))
    issues = items.where(vx.is_object(F.col("issue"))).select(
        "page_no", F.col("pos").cast("bigint").alias("pos"), "next_token", "issue"
    )
    return issues, rejects
