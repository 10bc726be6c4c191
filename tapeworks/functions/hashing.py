"""Record and payload digests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tapeworks.functions.parsing import blank_to_null, double_text, timestamp_text


def row_hash(*parts: Column) -> Column:
    """SHA-256 over the parts joined by ``|``; a null part is an empty text."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", *texts), 256)


def trade_hash(exchange: Column, isin: Column, event_ts: Column, price: Column,
               size: Column, flags_raw: Column) -> Column:
    """Digest of one trade.  The trade id is not part of it, so two real prints
    that agree in everything else share a digest (see ``dedupe`` keys)."""
    return row_hash(exchange, isin, timestamp_text(event_ts), double_text(price),
                    double_text(size), flags_raw)


def bar_hash(exchange: Column, isin: Column, event_ts: Column, close_text: Column) -> Column:
    return row_hash(exchange, isin, timestamp_text(event_ts), close_text)


def provenance_hash(message_hash: Column, payload_sha256: Column) -> Column:
    """The record's own digest, else the digest of the payload it came in."""
    return F.coalesce(blank_to_null(message_hash), payload_sha256)


def payload_digest(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def payload_size(content: Column) -> Column:
    return F.octet_length(content).cast("long")


def error_text(error: Column) -> Column:
    return F.substring(error, 1, 1024)
