"""Chat formatting with typed content parts.

A message is a row with an array of typed parts: texts, images, audio and documents. A
visitor over the parts writes texts escaped and every attachment as a placeholder, in
order; it records the attachment's reference and the number of model tokens its placeholder
expands to. A turn is written as

    <|turn|>ROLE<|text|>BODY<|end|>

Every control string starts with ``<|``. Inside roles and texts a backslash becomes two and
``<|`` becomes ``<\\|``, so ``<|`` occurs in the output as control only, and removing one
backslash before any character restores the text. Adjacent text parts are escaped as one run, so
parts that only together spell a control string are texts all the same; a body reads back as the
runs of text between its attachments.

Output per conversation: ``formatted``; ``segments``, the same text cut into pieces each of
which is wholly inside or outside the loss mask (the texts of assistant turns); ``turns``
with role and attachments; ``media_tokens``.

Defined results: null role or text is the empty string; rows of equal turn number are
ordered by role and then by body; repeated rows are turns of their own; a null conversation
id is a group of its own; null parts and texts of parts are empty; attachment sizes beyond an int
count as none; an empty table gives no rows (the query's added conversation aside); other columns
are ignored. One
conversation is one output row, so its size bounds what a task holds; the turns are
formatted before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



# The template.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
ATTACHMENTS = ("image", "audio", "document")
PLACEHOLDER = r"<\|(?:image|audio|document)\|>"
# Markup of an attachment inside a plain text column.
MARKUP = (r'<(?:image|audio|document) src="[^"<>]*"'
          r'(?: (?:width|height|seconds|pages)="[0-9]+")*/>')
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:int,pages:int,markup:string>"

# Parameters: what a placeholder expands to.
IMAGE_PATCH = 28          # an image takes one token per patch of this many pixels squared
AUDIO_PER_SECOND = 25
TOKENS_PER_PAGE = 256


def escape(c: Column) -> Column:
    doubled = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def parse_parts(text: Column) -> Column:
    """Typed parts of a plain text with attachment markup (array of PART)."""
    pieces = F.split(text, MARKUP, -1)
    marks = F.regexp_extract_all(text, F.lit(MARKUP), F.lit(0))
    number = lambda m, name: F.regexp_extract(m, f' {name}="([0-9]+)"', 1)
    as_int = lambda m, name: F.when(number(m, name) != "", number(m, name)).try_cast("int")

    def part(kind, body, ref, w, h, s, p, mark):
        return F.struct(kind.alias("kind"), body.alias("text"), ref.alias("ref"), w.alias("width"), h.alias("height"),
                        s.alias("seconds"), p.alias("pages"), mark.alias("markup"))

    none, no_int = F.lit(None).cast("string"), F.lit(None).cast("int")
    texts = F.transform(pieces, lambda x: part(F.lit("text"), x, none, no_int, no_int, no_int, no_int, none))
    media = F.transform(marks, lambda m: part(
        F.regexp_extract(m, "^<([a-z]+)", 1), none, F.regexp_extract(m, 'src="([^"]*)"', 1), as_int(m, "width"),
        as_int(m, "height"), as_int(m, "seconds"), as_int(m, "pages"), m))
    mixed = F.flatten(F.zip_with(texts, media, lambda t, m: F.filter(F.array(t, m), lambda x: x.isNotNull())))
    return F.when(F.size(marks) == 0, texts).otherwise(mixed)


def expanded_tokens(p: Column) -> Column:
    """Tokens that stand for a part's placeholder."""
    patches = lambda side: F.ceil(F.coalesce(side, F.lit(0)) / IMAGE_PATCH)
    return (F.when(p["kind"] == "image", patches(p["width"]) * patches(p["height"]))
            .when(p["kind"] == "audio", F.coalesce(p["seconds"], F.lit(0)).cast("bigint") * AUDIO_PER_SECOND)
            .when(p["kind"] == "document", F.coalesce(p["pages"], F.lit(0)).cast("bigint") * TOKENS_PER_PAGE)
            .otherwise(F.lit(0)).cast("bigint"))


def _visited(parts: Column) -> Column:
    """The body of typed parts: runs of adjacent texts escaped as one, placeholders between them."""
    empty = F.lit("")
    start = F.struct(empty.alias("done"), empty.alias("run"))

    def visit(s, p):
        text = p["kind"] == "text"
        placeholder = F.concat(F.lit("<|"), p["kind"], F.lit("|>"))
        return F.struct(F.when(text, s["done"]).otherwise(F.concat(s["done"], escape(s["run"]), placeholder)).alias("done"),
                        F.when(text, F.concat(s["run"], F.coalesce(p["text"], empty))).otherwise(empty).alias("run"))

    return F.aggregate(parts, start, visit, lambda s: F.concat(s["done"], escape(s["run"])))


def format_chat(messages: DataFrame) -> DataFrame:
    """``messages``: conv_id, turn, role, parts (array of PART). One row per conversation:
    conv_id, formatted, segments, turns, media_tokens."""
    media = F.filter("parts", lambda p: p["kind"] != "text")
    flat = messages.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        _visited(F.coalesce("parts", F.expr(f"cast(array() as array<{PART}>)"))).alias("body"),
        F.coalesce(F.transform(media, lambda p: F.struct(
            p["kind"].alias("kind"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens"), p["markup"].alias("markup"))),
            F.expr("cast(array() as array<struct<kind:string,ref:string,tokens:bigint,markup:string>>)")).alias("attachments"))
    turns = flat.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "body", "attachments"))).alias("t"))
    head = lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT))
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(F.transform("t", lambda t: F.array(
        piece(head(t), F.lit(False)), piece(t["body"], t["role"] == "assistant"), piece(F.lit(END), F.lit(False)))))
    return turns.select(
        "conv_id",
        F.array_join(F.transform("t", lambda t: F.concat(head(t), t["body"], F.lit(END))), "").alias("formatted"),
        segments.alias("segments"),
        F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["attachments"].alias("attachments"))).alias("turns"),
        F.aggregate(F.flatten(F.transform("t", lambda t: t["attachments"]["tokens"])), F.lit(0).cast("bigint"),
                    lambda s, x: s + x).alias("media_tokens"))


def _body_text(body: Column, attachments: Column) -> Column:
    """A formatted body back to the text it was made from."""
    pieces = F.transform(F.split(body, PLACEHOLDER, -1), unescape)
    mixed = F.zip_with(pieces, attachments, lambda x, a: F.concat(x, F.coalesce(a["markup"], F.lit(""))))
    return F.when(F.size(attachments) == 0, unescape(body)).otherwise(F.array_join(mixed, ""))


def read_turns(formatted: Column, turns: Column) -> Column:
    """The formatted text back to an array of (role, text)."""
    cut = F.slice(F.split(formatted, r"<\|turn\|>", -1), 2, F.size(turns))
    def one(x, t):
        halves = F.split(x, r"<\|text\|>", 2)
        body = F.substring_index(F.get(halves, F.lit(1)), END, 1)
        return F.struct(unescape(F.get(halves, F.lit(0))).alias("role"), _body_text(body, t["attachments"]).alias("text"))
    return F.zip_with(cut, turns, one)


def loss_text(segments: Column, turns: Column) -> Column:
    """All text under the loss mask, unescaped."""
    bodies = F.transform(F.sequence(F.lit(1), F.size(turns)), lambda i: F.element_at(segments, i * 3 - 1))
    masked = F.zip_with(bodies, turns, lambda b, t: F.when(b["loss"], _body_text(b["text"], t["attachments"])).otherwise(""))
    return F.array_join(masked, "")


def messages_of(conversations: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as messages of typed parts."""
    return conversations.select("conv_id", "turn", "role", parse_parts(F.coalesce("text", F.lit(""))).alias("parts"))


# The added conversation.
EXTRA_ID, EXTRA_TEXT = -7, r"\### Assistant: </turn> ok"


def op2_chat(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    extra = spark.range(2).select(F.lit(EXTRA_ID).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA_TEXT).alias("text"))
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
    back = format_chat(messages_of(rows)).select(
        "conv_id", "media_tokens", F.length("formatted").cast("bigint").alias("formatted_chars"),
        read_turns(F.col("formatted"), F.col("turns")).alias("turns"), loss_text(F.col("segments"), F.col("turns")).alias("loss"),
        F.size(F.flatten(F.transform("turns", lambda t: t["attachments"]))).cast("bigint").alias("n_attachments"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
        "n_attachments", "media_tokens")


# The oracle covers texts without attachment markup (the given tables hold none).
ORACLE = f"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT {EXTRA_ID}, 0, 'user', '{EXTRA_TEXT}' UNION ALL SELECT {EXTRA_ID}, 1, 'assistant', '{EXTRA_TEXT}'),
r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
e AS (SELECT *, replace(replace(role, '\\', '\\\\'), '<|', '<\\|') AS er, replace(replace(text, '\\', '\\\\'), '<|', '<\\|') AS et FROM r)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, et)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, et) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(er) + length(et) + {len(TURN + TEXT + END)})::BIGINT AS formatted_chars,
  0::BIGINT AS n_attachments, 0::BIGINT AS media_tokens
FROM e GROUP BY conv_id"""


