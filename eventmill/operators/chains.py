"""The order of pages as their cursors tell it, whatever numbers they were landed under."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.operators.pagectl import RUN
from eventmill.operators.running import same_keys
from eventmill.session import scratch_dir


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cursor_chains(headers: DataFrame) -> DataFrame:
    """Per page the page before it, its chain's first page, and its place there: ``step`` from 0.

    A page follows the one of its run and source that handed out the cursor it asks with, the
    lowest ``seq`` if several did.  ``link`` is ``start`` (asks without a cursor), ``orphan`` (asks with one
    that no page handed out), ``linked``, or ``loop``: the pages before it lead back to one of them, so
    there is no first page and no step.  ``siblings`` counts the pages that asked with the same cursor;
    more than one is a fork, such as a request that was repeated.

    Chains are followed by doubling: a page that knows the page 2 ** k before it learns from that one
    about the next 2 ** k.  A page that has found its first page asks no more, so no task is flooded
    with questions for the first page of a long chain.  The rounds are few, the logarithm of the
    longest chain, and each is written.
    """
    asked = F.col("request_cursor")
    handed = (
        headers.where(F.col("next_cursor").isNotNull())
        .groupBy(*[F.col(k).alias(f"_{k}") for k in RUN], F.col("next_cursor").alias("_cursor"))
        .agg(F.min("seq").alias("parent_seq"))
    )
    askers = headers.where(asked.isNotNull()).groupBy(*RUN, "request_cursor").agg(F.count("*").alias("siblings"))
    by_cursor = askers.join(
        handed, same_keys([*RUN, "request_cursor"], [*[f"_{k}" for k in RUN], "_cursor"]), "left"
    ).select(*[F.col(k).alias(f"_{k}") for k in RUN], F.col("request_cursor").alias("_cursor"), "siblings", "parent_seq")
    pages = _written(
        headers.select(*RUN, "seq", "request_cursor")
        .join(by_cursor, same_keys([*RUN, "request_cursor"], [*[f"_{k}" for k in RUN], "_cursor"]), "left")
        .select(*RUN, "seq", asked.isNull().alias("starts"), "siblings", "parent_seq"),
        "chain-links",
    )
    root = F.col("parent_seq").isNull()
    state = pages.select(
        *RUN,
        "seq",
        root.alias("done"),
        F.coalesce("parent_seq", "seq").alias("jump"),  # the first page once done
        F.when(root, 0).otherwise(1).cast("bigint").alias("step"),
    )
    rounds = pages.count().bit_length() + 1  # what is not done by then runs in a loop
    for _ in range(rounds):
        state = _written(state, "chain-state")
        if state.where("NOT done").isEmpty():
            break
        ahead = state.select(
            *[F.col(k).alias(f"_{k}") for k in RUN],
            F.col("seq").alias("_seq"),
            F.col("done").alias("_done"),
            F.col("jump").alias("_jump"),
            F.col("step").alias("_step"),
        )
        moved = (
            state.where("NOT done")
            .join(ahead, same_keys([*RUN, "jump"], [*[f"_{k}" for k in RUN], "_seq"]))
            .select(
                *RUN,
                "seq",
                F.col("_done").alias("done"),
                F.col("_jump").alias("jump"),
                (F.col("step") + F.col("_step")).alias("step"),
            )
        )
        state = state.where("done").unionByName(moved)
    found = state.select(
        *[F.col(k).alias(f"_{k}") for k in RUN], F.col("seq").alias("_seq"), "done", "jump", "step"
    )
    done = F.col("done")
    return pages.join(found, same_keys([*RUN, "seq"], [*[f"_{k}" for k in RUN], "_seq"])).select(
        *RUN,
        "seq",
        "parent_seq",
        F.when(done, F.col("jump")).alias("head_seq"),
        F.when(done, F.col("step")).alias("step"),
        "siblings",
        F.when(F.col("starts"), "start")
        .when(F.col("parent_seq").isNull(), "orphan")
        .when(done, "linked")
        .otherwise("loop")
        .alias("link"),
    )
