"""Fixture mapping of the mailbox: raw messages as JSON, derived from the documents table.

The message API delivers nested JSON with base64url bodies.  This builds the
same shape from ``documents``, one layout per language, so that the message
jobs have whole texts to work on:

* en: a text/plain part beside an HTML part
* fr: a multipart part that holds HTML and text/plain, and a repeated header
* de: the body directly in the payload, a bare sender address
* es: an HTML part only
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefunnel.functions.exprs import base64url


def raw_messages(documents: DataFrame) -> DataFrame:
    """(id, received_at, message JSON) of every document."""
    ident = F.col("doc_id").cast("string")
    lang = F.col("lang")

    def header(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    def body(text: Column) -> Column:
        return F.struct(base64url(text).alias("data"))

    subject = F.when(F.col("doc_id") % 9 != 0, F.concat(F.lit("Subject "), "source"))
    address = F.concat(F.lit("user"), ident, F.lit("@example.com"))
    sender = F.when(lang == "de", address).otherwise(F.concat(F.lit("Some One <"), address, F.lit(">")))
    headers = F.filter(
        F.array(
            F.when(lang == "fr", header("subject", F.lit("An earlier subject"))),
            header("FROM", sender),
            F.when(subject.isNotNull(), header("Subject", subject)),
            header("Message-ID", F.concat(F.lit("<m"), ident, F.lit("@example.com>"))),
            F.when(lang == "en", header("To", F.lit("shop@example.com"))),
        ),
        lambda h: h.isNotNull(),
    )
    leaf = "struct<mimeType:string,body:struct<data:string>>"
    node = f"struct<mimeType:string,body:struct<data:string>,parts:array<{leaf}>>"
    html = body(F.concat(F.lit("<p>"), "text", F.lit("</p>")))
    plain = body(F.col("text"))

    def part(mime: str, content: Column | None, parts: Column | None = None) -> Column:
        return F.struct(
            F.lit(mime).alias("mimeType"),
            (content if content is not None else F.lit(None)).alias("body"),
            (parts if parts is not None else F.lit(None)).alias("parts"),
        ).cast(node)

    def nested(mime: str, content: Column) -> Column:
        return F.struct(F.lit(mime).alias("mimeType"), content.alias("body")).cast(leaf)

    parts = (
        F.when(lang == "en", F.array(part("text/html", html), part("text/plain", plain)))
        .when(
            lang == "fr",
            F.array(
                part(
                    "multipart/alternative",
                    None,
                    F.array(nested("text/html", html), nested("text/plain", plain)),
                )
            ),
        )
        .when(lang == "es", F.array(part("text/html", html)))
    )
    labels = F.filter(
        F.array(
            F.when(F.col("source") != "src5", "INBOX").otherwise("SENT"),
            F.when(F.col("doc_id") % 3 == 0, "UNREAD"),
            F.when(F.col("source") == "src3", "CATEGORY_PROMOTIONS"),
            F.when(F.col("source") == "src7", "CATEGORY_SOCIAL"),
        ),
        lambda s: s.isNotNull(),
    )
    # mails arrive one minute apart
    received = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("doc_id") * 60)
    payload = F.struct(
        headers.alias("headers"),
        F.when(lang == "de", plain).alias("body"),
        parts.alias("parts"),
    )
    message = F.struct(
        F.concat(F.lit("msg_"), ident).alias("id"),
        F.concat(F.lit("thread_"), ident).alias("threadId"),
        F.substring("text", 1, 40).alias("snippet"),
        F.unix_millis(received).cast("string").alias("internalDate"),
        labels.alias("labelIds"),
        payload.alias("payload"),
    )
    return documents.select(
        F.concat(F.lit("msg_"), ident).alias("id"),
        received.alias("received_at"),
        F.to_json(message).alias("message"),
    )

