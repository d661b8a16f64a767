from __future__ import annotations

import base64
import json

from pyspark.sql import functions as F

from tidefunnel.plans.mail import (
    compose_replies,
    normalize_messages,
    reply_address,
    select_unread,
)


def b64(text) -> str:
    raw = text if isinstance(text, bytes) else text.encode()
    return base64.urlsafe_b64encode(raw).decode().rstrip("=")


def message(ident: str, payload: dict, **extra) -> str:
    return json.dumps({"id": ident, "threadId": "t" + ident, "payload": payload, **extra})


def frame(spark, messages):
    return spark.createDataFrame([(m,) for m in messages], "message string")


def part(mime: str, text=None, parts=None) -> dict:
    out: dict = {"mimeType": mime}
    if text is not None:
        out["body"] = {"data": b64(text)}
    if parts is not None:
        out["parts"] = parts
    return out


def bodies(spark, *payloads):
    df = normalize_messages(frame(spark, [message(str(i), p) for i, p in enumerate(payloads)]))
    return [r.body_text for r in df.orderBy("gmail_message_id").collect()]


def test_plain_body_search_order(spark):
    assert bodies(
        spark,
        {"parts": [part("text/html", "<p>"), part("text/plain", "plain é")]},
        {"parts": [part("multipart/alternative", parts=[part("text/html", "h"), part("text/plain", "nested")])]},
        # a text/plain part wins over an earlier multipart
        {"parts": [part("multipart/mixed", parts=[part("text/plain", "no")]), part("text/plain", "yes")]},
        {"parts": [part("multipart/mixed", "own body", [part("text/plain", "no")])]},
        {"parts": [part("text/html", "only html")]},
        {"parts": [], "body": {"data": b64("ignored")}},
        {"body": {"data": b64("single >>> ??? body")}},
        {},
        {"body": {"data": b64(b"bad \xff byte")}},
        {"parts": [part("text/plain", ""), part("multipart/mixed", parts=[part("text/plain", "no")])]},
    ) == [
        "plain é", "nested", "yes", "own body", "", "", "single >>> ??? body", "", "bad � byte", "",
    ]


def test_headers_ignore_case_and_the_last_one_wins(spark):
    headers = [
        {"name": "SUBJECT", "value": "one"}, {"name": "subject", "value": "two"},
        {"name": "From", "value": "A <a@x>"}, {"name": "message-id", "value": "<1>"},
    ]
    row = normalize_messages(frame(spark, [message("1", {"headers": headers}), message("2", {})]))
    first, second = row.orderBy("gmail_message_id").collect()
    assert (first.subject, first.from_address, first.to_address, first.message_id_header) == (
        "two", "A <a@x>", None, "<1>",
    )
    assert (second.subject, second.from_address, second.message_id_header) == ("", "", None)


def test_reply_address(spark):
    df = spark.createDataFrame([("A <a@x> <b@x>",), ("c@x",), ("<>",), ("broken <d@x",)], "s string")
    got = [r.a for r in df.select(reply_address(F.col("s")).alias("a")).collect()]
    assert got == ["a@x", "c@x", "", "broken <d@x"]


def test_compose_replies(spark):
    df = spark.createDataFrame(
        [("1", "A <a@x>", "Re: hi", "<m1>", "answer ü"), ("2", "b@x", "", None, "x" * 200),
         ("3", "c@x", "re: low", "", "y")],
        "gmail_message_id string, from_address string, subject string, message_id_header string, answer string",
    )
    got = {r.gmail_message_id: r for r in compose_replies(df).collect()}

    def text(i: str) -> str:
        raw = got[i].raw
        assert not set(raw) & set("+/=\r\n")
        return base64.urlsafe_b64decode(raw + "=" * (-len(raw) % 4)).decode()

    tail = "Content-Type: text/plain; charset=utf-8\r\n\r\n"
    assert text("1") == (
        f"To: a@x\r\nSubject: Re: hi\r\nIn-Reply-To: <m1>\r\nReferences: <m1>\r\n{tail}answer ü"
    )
    assert text("2") == f"To: b@x\r\nSubject: Re: Your question\r\n{tail}" + "x" * 200
    assert text("3") == f"To: c@x\r\nSubject: Re: re: low\r\n{tail}y"


def test_select_unread(spark):
    def mail(i: int, *labels: str) -> str:
        return message(str(i), {}, labelIds=list(labels), internalDate=str(i))

    df = frame(spark, [
        mail(1, "INBOX", "UNREAD"), mail(2, "INBOX"), mail(3, "INBOX", "UNREAD", "CATEGORY_SOCIAL"),
        mail(10, "INBOX", "UNREAD"), mail(9, "INBOX", "UNREAD"), mail(11, "UNREAD"), "not json",
        mail(12, "INBOX", "UNREAD", "CATEGORY_PROMOTIONS"),
    ])
    assert [r.gmail_message_id for r in select_unread(df, 2).collect()] == ["10", "9"]
