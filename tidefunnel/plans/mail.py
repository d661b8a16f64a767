"""Mail jobs: unread selection, normalisation, replies, retrieval and prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefunnel.functions.exprs import base64url, rounded
from tidefunnel.operators.cells import VectorIndex
from tidefunnel.operators.tables import folder_exists
from tidefunnel.operators.vectors import nearest, nearest_tiled
from tidefunnel.registry import register
from tidefunnel.session import work_folder
from tidefunnel.sources.warehouse import Warehouse

BATCH_SIZE = 5  # mails taken per poll
NEIGHBOURS = 5  # hits per question
CELLS = 16  # of the stored index; the square root of the number of mails is a good choice
PROBES = 11  # cells a question is compared with; vectors without clusters need most of them
CONTEXT_CHARS = 1500  # body characters per hit; a feature of the prompt

LEAF = "struct<mimeType: string, body: struct<data: string>>"
MESSAGE = (
    "id string, threadId string, snippet string, internalDate string, labelIds array<string>,"
    " payload struct<headers: array<struct<name: string, value: string>>,"
    " body: struct<data: string>, parts: array<struct<mimeType: string,"
    f" body: struct<data: string>, parts: array<{LEAF}>>>>"
)

# The prompt text.
PROMPT = (
    "You are an expert marketing analyst.\n\n"
    "Context (may be incomplete):\n%s\n\n"
    "Task: Answer the user's question using only the provided context. If the context is"
    " insufficient, say what is missing and ask up to 1 clarifying question. Be concise.\n\n"
    "Question: %s"
)


# --- messages -------------------------------------------------------------------------


def parsed(messages: DataFrame, column: str = "message") -> DataFrame:
    """Message JSON as typed columns; unreadable JSON gives a NULL id."""
    return messages.withColumn("m", F.from_json(column, MESSAGE))


def select_unread(messages: DataFrame, limit: int = BATCH_SIZE) -> DataFrame:
    """Newest unread inbox mails that are neither promotions nor social."""
    labels = F.col("m.labelIds")

    def has(label: str) -> Column:
        return F.array_contains(labels, label)

    return (
        parsed(messages)
        .where(has("INBOX") & has("UNREAD") & ~has("CATEGORY_PROMOTIONS") & ~has("CATEGORY_SOCIAL"))
        .orderBy(F.desc(F.col("m.internalDate").cast("long")), "m.id")
        .limit(limit)
        .select(F.col("m.id").alias("gmail_message_id"), F.col("m.threadId").alias("gmail_thread_id"))
    )


def _header(name: str) -> Column:
    """Value of the last header of that name, in any letter case."""
    same = F.filter("m.payload.headers", lambda h: F.lower(h["name"]) == name)
    return F.get(same, F.size(same) - 1)["value"]


def _decoded(data: Column) -> Column:
    """Text of a base64url body; bytes that are no UTF-8 become U+FFFD."""
    plain = F.replace(F.replace(data, F.lit("-"), F.lit("+")), F.lit("_"), F.lit("/"))
    return F.make_valid_utf8(F.unbase64(plain).cast("string"))


def _filled(text: Column) -> Column:
    return F.when(text != "", text)


def plain_body() -> Column:
    """The text/plain body: of a part, of a nested part, or of the payload."""
    parts = F.col("m.payload.parts")

    def is_plain(p: Column) -> Column:
        return p["mimeType"] == "text/plain"

    plain = F.get(F.filter(parts, is_plain), F.lit(0))
    multi = F.get(F.filter(parts, lambda p: p["mimeType"].startswith("multipart")), F.lit(0))
    part = F.coalesce(plain, multi)
    nested = F.get(F.filter(part["parts"], is_plain), F.lit(0))
    data = F.when(
        parts.isNotNull(),
        F.coalesce(_filled(part["body"]["data"]), _filled(nested["body"]["data"])),
    ).otherwise(_filled(F.col("m.payload.body.data")))
    return F.coalesce(_decoded(data), F.lit(""))


def normalize_messages(messages: DataFrame, *more: str) -> DataFrame:
    """Sender, recipient, subject, plain body and message id of raw messages (and the columns ``more``)."""
    return parsed(messages).select(
        *more,
        F.col("m.id").alias("gmail_message_id"),
        F.col("m.threadId").alias("gmail_thread_id"),
        F.coalesce(_header("from"), F.lit("")).alias("from_address"),
        _header("to").alias("to_address"),
        F.coalesce(_header("subject"), F.lit("")).alias("subject"),
        F.col("m.snippet").alias("snippet"),
        plain_body().alias("body_text"),
        _header("message-id").alias("message_id_header"),
    )


def reply_address(sender: Column) -> Column:
    """What stands between the first angle brackets, else the whole sender."""
    pattern = F.lit("<(.*?)>")
    return F.when(F.regexp_like(sender, pattern), F.regexp_extract(sender, "<(.*?)>", 1)).otherwise(sender)


def compose_replies(mails: DataFrame) -> DataFrame:
    """The encoded reply message of each mail; ``answer`` is the reply text."""
    subject = F.coalesce(_filled(F.col("subject")), F.lit("Your question"))
    reply_subject = F.when(subject.startswith("Re:"), subject).otherwise(
        F.concat(F.lit("Re: "), subject)
    )
    ident = _filled(F.col("message_id_header"))
    to = reply_address(F.col("from_address"))
    # concat_ws leaves out the NULL reference lines of mails without an id
    lines = F.concat_ws(
        "\r\n",
        F.concat(F.lit("To: "), to),
        F.concat(F.lit("Subject: "), reply_subject),
        F.concat(F.lit("In-Reply-To: "), ident),
        F.concat(F.lit("References: "), ident),
        F.lit("Content-Type: text/plain; charset=utf-8"),
        F.lit(""),
        F.col("answer"),
    )
    return mails.select(
        "gmail_message_id", to.alias("to_address"), reply_subject.alias("subject"), base64url(lines).alias("raw")
    )


# --- retrieval ------------------------------------------------------------------------


def corpus(wh: Warehouse) -> DataFrame:
    """Vectors of stored mails."""
    ids = wh.table("emails").select(F.col("id").alias("email_id"))
    return wh.table("email_embeddings").join(ids, "email_id", "left_semi")


def poll_questions(wh: Warehouse, limit: int = BATCH_SIZE) -> DataFrame:
    """The newest unanswered mails of one poll, with their vectors."""
    new = wh.table("emails").where("status = 'new'").select(
        F.col("id").alias("email_id"), "subject", "body_text"
    )
    vectors = wh.table("email_embeddings")
    known = new.select("email_id").join(vectors.select("email_id"), "email_id", "left_semi")
    # at most ``limit`` ids; texts and vectors meet them without a shuffle
    newest = F.broadcast(known.orderBy(F.desc("email_id")).limit(limit))
    found = new.join(newest, "email_id", "left_semi")
    return found.join(vectors.join(newest, "email_id", "left_semi"), "email_id").select(
        F.col("email_id").alias("question_id"), "embedding", "subject", "body_text"
    )


def similarity_search(wh: Warehouse, questions: DataFrame | None = None, k: int = NEIGHBOURS) -> DataFrame:
    """The k nearest mails per question: ordered by Euclidean distance, with
    the cosine similarity.  A stored question is its own nearest mail."""
    questions = poll_questions(wh) if questions is None else questions
    return nearest(corpus(wh), questions, k)


def similarity_search_many(wh: Warehouse, k: int = NEIGHBOURS, every: int = 100) -> DataFrame:
    """As :func:`similarity_search`, with every stored mail whose id is divisible by ``every`` as a question."""
    return nearest_tiled(corpus(wh), _every(wh, every), k)


def _every(wh: Warehouse, every: int) -> DataFrame:
    return corpus(wh).where(F.col("email_id") % every == 0).withColumnRenamed("email_id", "question_id")


def mail_index(wh: Warehouse, root: str, cells: int = CELLS) -> VectorIndex:
    """The index below ``root``: opened if it is there, else fitted; new and changed mails are added."""
    if folder_exists(wh.spark, f"{root}/centres"):
        index = VectorIndex.open(wh.spark, root)
    else:
        index = VectorIndex.create(corpus(wh), root, cells)
    index.add(corpus(wh))
    return index


def similarity_search_ann(
    wh: Warehouse,
    questions: DataFrame | None = None,
    k: int = NEIGHBOURS,
    probes: int = PROBES,
    index: VectorIndex | None = None,
) -> DataFrame:
    """As :func:`similarity_search`, but over the cells of the nearest centres only.

    Pass the ``index`` that :func:`mail_index` keeps; without one it is built for this call.
    """
    index = index or mail_index(wh, work_folder(wh.spark, "mail-index"))
    return index.search(poll_questions(wh) if questions is None else questions, k, probes)


def similarity_search_ann_recall(
    wh: Warehouse, k: int = NEIGHBOURS, probes: int = PROBES, every: int = 100, least: float = 0.9
) -> DataFrame:
    """Share of the true neighbours that the stored index finds, over every id divisible by ``every``."""
    index = mail_index(wh, work_folder(wh.spark, "mail-index"))
    exact = similarity_search_many(wh, k, every).select("question_id", "email_id")
    found = similarity_search_ann(wh, _every(wh, every), k, probes, index)
    found = found.select("question_id", "email_id", F.lit(1).alias("hit"))
    return (
        exact.join(found, ["question_id", "email_id"], "left")
        .agg(
            F.countDistinct("question_id").alias("questions"),
            F.count("*").alias("neighbours"),
            F.count("hit").alias("found"),
        )
        .select("questions", "neighbours", "found", (F.col("found") >= least * F.col("neighbours")).alias("recall_reached"))
    )


def _contexts(wh: Warehouse, questions: DataFrame, k: int) -> DataFrame:
    """Per question of one poll: its hits as numbered text blocks, best first."""
    # at most BATCH_SIZE * k hits; the texts of all other mails stay where they are
    hits = F.broadcast(similarity_search(wh, questions, k))
    mails = wh.table("emails").select(F.col("id").alias("email_id"), "subject", "body_text")
    text = F.format_string(
        "[#%d sim=%.3f] subject: %s\n%s",
        F.col("rank"),
        F.col("similarity"),
        F.coalesce(_filled(F.col("subject")), F.lit("(no subject)")),
        F.substring(F.coalesce("body_text", F.lit("")), 1, CONTEXT_CHARS),
    )
    # at most k hits per question
    blocks = F.sort_array(F.collect_list(F.struct("rank", text.alias("text"))))
    return (
        hits.join(mails, "email_id")
        .groupBy("question_id")
        .agg(F.concat_ws("\n\n", F.transform(blocks, lambda b: b["text"])).alias("context"))
    )


def build_context(wh: Warehouse, k: int = NEIGHBOURS) -> DataFrame:
    return _contexts(wh, poll_questions(wh), k)


def build_prompt(wh: Warehouse, k: int = NEIGHBOURS) -> DataFrame:
    questions = poll_questions(wh)
    question = F.coalesce(_filled(F.col("body_text")), _filled(F.col("subject")), F.lit(""))
    return (
        questions.select("question_id", question.alias("question"))
        .join(_contexts(wh, questions, k), "question_id")
        .select("question_id", F.format_string(PROMPT, "context", "question").alias("prompt"))
    )


def reply_usage_stats(wh: Warehouse) -> DataFrame:
    """Replies and tokens by model, and mails by status."""
    by_model = (
        wh.table("email_replies")
        .groupBy(F.lit("model").alias("kind"), F.col("model").alias("name"))
        .agg(
            F.count("*").alias("items"),
            F.sum("tokens_prompt").alias("prompt_tokens"),
            F.sum("tokens_completion").alias("completion_tokens"),
        )
    )
    by_status = (
        wh.table("emails")
        .groupBy(F.lit("status").alias("kind"), F.col("status").alias("name"))
        .agg(F.count("*").alias("items"))
    )
    return by_model.unionByName(by_status, allowMissingColumns=True)


# --- registered queries -----------------------------------------------------------------


def _q_reply_address(wh: Warehouse) -> DataFrame:
    mails = normalize_messages(wh.table("messages"))
    return mails.select("gmail_message_id", reply_address(F.col("from_address")).alias("reply_address"))


def _q_compose_reply(wh: Warehouse) -> DataFrame:
    mails = normalize_messages(wh.table("messages")).withColumn("answer", F.col("body_text"))
    return compose_replies(mails)


def _rounded_hits(hits: DataFrame) -> DataFrame:
    return hits.select("question_id", "rank", "email_id", rounded("similarity", 6).alias("similarity"))


for _key, _plan in {
    "select_unread_batch": lambda wh: select_unread(wh.table("messages")),
    "normalize_messages": lambda wh: normalize_messages(wh.table("messages")),
    "reply_address": _q_reply_address,
    "compose_reply": _q_compose_reply,
    "similarity_search": lambda wh: _rounded_hits(similarity_search(wh)),
    "similarity_search_ann": lambda wh: _rounded_hits(similarity_search_ann(wh)),
    "similarity_search_many": lambda wh: _rounded_hits(similarity_search_many(wh)),
    "similarity_search_ann_recall": lambda wh: similarity_search_ann_recall(wh).drop("found"),
    "build_context": build_context,
    "build_prompt": build_prompt,
    "reply_usage_stats": reply_usage_stats,
}.items():
    register(_key, _plan)
