"""Deliveries by message: links in texts and attached files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tapeworks.functions import links as L


def matching_messages(messages: DataFrame, *, sender: str | None = None,
                      recipient: str | None = None, since: Column | None = None) -> DataFrame:
    """Messages from a sender to a recipient since a day; the time of day is ignored."""
    if sender:
        messages = messages.where(F.contains(F.lower("sender"), F.lit(sender.lower())))
    if recipient:
        messages = messages.where(F.contains(F.lower("recipient"), F.lit(recipient.lower())))
    if since is not None:
        messages = messages.where(F.to_date("received_at") >= F.to_date(since))
    return messages


def latest_link(messages: DataFrame, *, by: str = "recipient", order: list[str]) -> DataFrame:
    """Per ``by`` the link of the newest message that holds one.

    An aggregation: each task keeps one message per key, however many there are.
    """
    linked = (messages.withColumn("link", L.delivery_link(F.col("text")))
              .where(F.col("link").isNotNull()))
    newest = linked.groupBy(by).agg(F.max_by(F.struct("link", *order),
                                             F.struct(*order)).alias("m"))
    return newest.select(by, "m.link", *[F.col(f"m.{c}").alias(c) for c in order])


def attachments(messages: DataFrame) -> DataFrame:
    """Named, non-empty attachments; ``attachments`` is an array of
    ``struct(disposition, filename, content)``."""
    keep = [c for c in messages.columns if c != "attachments"]
    found = messages.select(*keep, F.posexplode("attachments").alias("part", "a"))
    return (found.where((F.col("a.disposition") == "attachment") & (F.col("a.filename") != "")
                        & (F.octet_length("a.content") > 0))
            .select(*keep, "part", L.basename(F.col("a.filename")).alias("filename"),
                    F.col("a.content").alias("content")))


def latest_attachments(messages: DataFrame, *, by: str = "recipient", order: list[str],
                       ) -> DataFrame:
    """All attachments of the newest message per ``by`` that has any.

    Only keys and order columns are aggregated; the contents stay where they are
    until the message is known.
    """
    usable = F.exists("attachments", lambda a: (a["disposition"] == "attachment")
                      & (a["filename"] != "") & (F.octet_length(a["content"]) > 0))
    newest = (messages.where(usable).groupBy(by)
              .agg(F.max(F.struct(*order)).alias("_newest"))
              .select(by, *[F.col(f"_newest.{c}").alias(c) for c in order]))
    return attachments(messages.join(newest, [by, *order]))
