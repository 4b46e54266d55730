"""Body cleaning and classification texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadsift.functions.scalars import stable_id
from threadsift.functions.text import ENTITIES, clean_body
from threadsift.operators import threads
from threadsift.registry import query

_BLANKS = "' ' || chr(9) || chr(10) || chr(13) || chr(12)"


def _replaced(column: str, pattern: str, replacement: str = "''") -> str:
    return f"REGEXP_REPLACE({column}, '{pattern}', {replacement}, 'g')"


def _html_sql(column: str) -> str:
    """The HTML rules for DuckDB, whose regular expressions know no back references."""
    text = column
    for pattern, replacement in (
        (r"(?is)^.*?<body\b[^>]*>", "''"),
        (r"(?is)</body\b.*$", "''"),
        (r"(?s)<!--.*?-->", "''"),
        (r"(?is)<script\b[^>]*>.*?</script\s*>", "''"),
        (r"(?is)<style\b[^>]*>.*?</style\s*>", "''"),
        (r"\s+", "' '"),
        (r'(?i)<a\b[^>]*?\bhref="([^"]*)"[^>]*>(.*?)</a\s*>', r"chr(3) || '\2' || chr(4) || '\1' || chr(5)"),
    ):
        text = _replaced(text, pattern, replacement)
    link = (
        "CASE WHEN CONTAINS(x, chr(4)) THEN SPLIT_PART(x, chr(4), 1) || CASE WHEN SPLIT_PART(x, chr(4), 1)"
        " = SPLIT_PART(SPLIT_PART(x, chr(4), 2), chr(5), 1) THEN '' ELSE ' [' || SPLIT_PART(SPLIT_PART(x, chr(4), 2), chr(5), 1)"
        " || ']' END || SPLIT_PART(x, chr(5), 2) ELSE x END"
    )
    text = f"ARRAY_TO_STRING([{link} for x in STRING_SPLIT({text}, chr(3))], '')"
    for pattern, replacement in (
        (r"(?i)<h[1-6]\b[^>]*>", "chr(10) || chr(10) || chr(1)"),
        (r"(?i)</h[1-6]\s*>", "chr(2) || chr(10) || chr(10)"),
        (r"(?i)<li\b[^>]*>", "chr(10) || ' * '"),
        (
            r"(?i)<br\b[^>]*>|</?(div|tr|nav|section|article|header|footer|main|aside|address|form|hr)\b[^>]*>|</li\s*>",
            "chr(10)",
        ),
        (r"(?i)</?(p|ul|ol|table|blockquote|pre)\b[^>]*>", "chr(10) || chr(10)"),
        (r"</?[A-Za-z!][^>]*>", "''"),
        (r"\n +([^* ])", r"chr(10) || '\1'"),
        (r" +\n", "chr(10)"),
    ):
        text = _replaced(text, pattern, replacement)
    title = (
        "CASE WHEN CONTAINS(x, chr(2)) THEN UPPER(REPLACE(SPLIT_PART(x, chr(2), 1), 'ß', 'SS')) || SPLIT_PART(x, chr(2), 2)"
        " ELSE x END"
    )
    text = f"ARRAY_TO_STRING([{title} for x in STRING_SPLIT({text}, chr(1))], '')"
    for entity, character in ENTITIES.items():
        text = f"REPLACE({text}, '&{entity};', '{character.replace(chr(39), chr(39) * 2)}')"
    return f"TRIM({text}, {_BLANKS})"


def clean_sql(source: str, key: str, body: str) -> str:
    """SELECT key columns and `clean`, step by step."""
    quotes = _replaced("t", r"(?m)^>[^\n]*\n?")
    quotes = _replaced(quotes, r"(?m)^On [^\n]*(?:\n[^\n]*)?wrote:[ \t]*$")
    quotes = _replaced(quotes, r"(^|\n)(--|__|Sent from my [^\n]*)[ \t]*(\n(?s:.*))?\z")
    spaces = _replaced("t", r"\n{3,}", "chr(10) || chr(10)")
    spaces = _replaced(spaces, r"[ \t]{2,}", "' '")
    spaces = _replaced(spaces, r"(?m)^\s+$")
    return f"""
SELECT {key}, CASE WHEN LENGTH(t) > 3000 THEN SUBSTR(t, 1, 3000) || chr(10) || '[... truncated]' ELSE t END AS clean
FROM (SELECT {key}, TRIM({spaces}, {_BLANKS}) AS t
FROM (SELECT {key}, CASE WHEN TRIM(v, {_BLANKS}) <> '' THEN v ELSE t END AS t
FROM (SELECT {key}, t, {quotes} AS v
FROM (SELECT {key}, CASE WHEN CONTAINS(t, '<') AND (CONTAINS(t, '</') OR CONTAINS(t, '/>')) THEN {_html_sql('t')} ELSE t END AS t
FROM (SELECT {key}, REPLACE(COALESCE({body}, ''), chr(13) || chr(10), chr(10)) AS t FROM {source}) s0) s1) s2) s3) s4"""


@query("txt_1_clean_pages", clean_sql("pages", "page_id", "html"))
def txt_1_pages(t):
    return t.pages.select("page_id", clean_body(F.col("html")).alias("clean"))


@query("txt_1b_clean_documents", clean_sql("documents", "doc_id", "text"))
def txt_1_documents(t):
    return t.documents.select("doc_id", clean_body(F.col("text")).alias("clean"))


# A body of each conversation turn as a mail that quotes the page it answers.
_REPLY_BODY = """text || chr(10) || chr(10) || 'On Mon, Ann wrote:' || chr(10) || '> quoted line' || chr(10) || '> more'
 || CASE WHEN turn % 2 = 0 THEN chr(13) || chr(10) || '--' || chr(10) || 'Ann Lee' ELSE '' END"""


@query("txt_1c_clean_replies", clean_sql(f"(SELECT conv_id, turn, {_REPLY_BODY} AS body FROM conversations) c", "conv_id, turn", "body"))
def txt_1_replies(t):
    body = F.concat(
        F.col("text"),
        F.lit("\n\nOn Mon, Ann wrote:\n> quoted line\n> more"),
        F.when(F.col("turn") % 2 == 0, F.lit("\r\n--\nAnn Lee")).otherwise(""),
    )
    return t.conversations.select("conv_id", "turn", clean_body(body).alias("clean"))


# An HTML reply to each turn: its words, a numbered list with a list in it, a table, quotes in quotes.
_WORDS = "TRIM(REGEXP_REPLACE(text, '[^A-Za-z]+', ' ', 'g'))"
_REPLY_TEXT = f"""CASE WHEN {_WORDS} = '' THEN '' ELSE {_WORDS} || chr(10) || chr(10) END
 || ' ' || CAST(turn + 2 AS STRING) || '. ' || role || chr(10) || ' * in' || chr(10) || chr(10) || ' ' || CAST(turn + 3 AS STRING) || '. two'
 || chr(10) || chr(10) || 'conv turn' || chr(10) || chr(10) || CAST(conv_id AS STRING) || ' ' || CAST(turn AS STRING) || chr(10) || chr(10) || 'end'"""


@query("txt_1d_nested_html", f"""
SELECT conv_id, turn, CASE WHEN LENGTH(t) > 3000 THEN SUBSTR(t, 1, 3000) || chr(10) || '[... truncated]' ELSE t END AS clean
FROM (SELECT conv_id, turn, TRIM({_REPLY_TEXT}, {_BLANKS}) AS t FROM conversations) x""")
def txt_1_nested(t):
    words = F.trim(F.regexp_replace("text", "[^A-Za-z]+", " "))
    body = F.format_string(
        "<html><body><div>%s</div><ol start='%d'><li>%s<ul><li>in</li></ul></li><li>two</li></ol>"
        "<table><tr><th>conv</th><th>turn</th></tr><tr><td>%d</td><td>%d</td></tr></table>"
        "<blockquote>quoted<blockquote>deeper</blockquote>after</blockquote><p>end</p></body></html>",
        words, F.col("turn") + 2, F.col("role"), F.col("conv_id"), F.col("turn"),
    )
    return t.conversations.select("conv_id", "turn", clean_body(body).alias("clean"))


# What mail programs of four languages put around an answer, by turn.
_AROUND = (
    ("Le 3 janv. 2024 à 10:00, Ann <a@b.c> a écrit :\n> ancien", "Envoyé de mon iPhone"),
    ("Am 3. Jan. 2024 schrieb Ann <a@b.c>:\n> alt", "Von meinem iPhone gesendet"),
    ("El 3 ene 2024, Ann escribió:\n> viejo", "Enviado desde mi iPhone"),
    ("From: Ann\nSent: Monday\nTo: Bo\nSubject: Offer", "--\nAnn Lee\n\nSent from my phone"),
)


@query("txt_1e_reply_fragments", f"""
SELECT conv_id, turn, CASE WHEN LENGTH(t) > 3000 THEN SUBSTR(t, 1, 3000) || chr(10) || '[... truncated]' ELSE t END AS clean
FROM (SELECT conv_id, turn, 'Answer ' || {_WORDS} AS t FROM conversations) x""")
def txt_1_fragments(t):
    words = F.concat(F.lit("Answer "), F.trim(F.regexp_replace("text", "[^A-Za-z]+", " ")))
    kind = F.pmod("turn", F.lit(len(_AROUND))).cast("int")
    quote, signature = (F.get(F.array(*[F.lit(pair[i]) for pair in _AROUND]), kind) for i in (0, 1))
    body = F.concat_ws("\n\n", words, signature, quote)
    return t.conversations.select("conv_id", "turn", clean_body(body).alias("clean"))


# ---- threads from conversations ---------------------------------------------------
_THREADS_PER_BATCH = 5
TEMPLATE = "Classify these threads.\n\n{{THREAD_DATA}}\n\nAnswer in JSON.\n"
LLAMA_TEMPLATE = "Llama: {{THREAD_DATA}}\n"


def conversation_messages(t):
    """Conversations as mail threads: assistants are creators, system turns come from a third sender."""
    conversations = t.conversations
    creator = F.concat(F.lit("u"), F.col("conv_id").cast("string"), F.lit("@creator.com"))
    thread_id = F.concat(F.lit("c-"), F.col("conv_id").cast("string"))
    pairs = [
        (
            "From",
            F.when(F.col("role") == "assistant", creator)
            .when(F.col("role") == "system", "Sys <sys@brand.com>")
            .otherwise("Ann <ann@brand.com>"),
        ),
        ("Date", F.concat(F.lit("day "), F.col("turn").cast("string"))),
        ("Subject", F.concat(F.lit("Deal "), F.col("conv_id").cast("string"))),
    ]
    headers = F.array(*[F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in pairs])
    return conversations.select(
        thread_id.alias("thread_id"),
        F.concat_ws("-", thread_id, "turn").alias("message_id"),
        F.col("turn").alias("position"),
        headers.alias("headers"),
        F.when(F.col("turn") != 1, F.col("text")).alias("body"),
        F.when(F.col("turn") == 1, F.col("text")).alias("reply_body"),
        F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("earlier "), thread_id)).alias("previous_ai_summary"),
    )


def conversation_batches(t):
    """Conversations in batches of five threads of one user."""
    users = conversation_messages(t).withColumn(
        "user_id", F.concat(F.lit("u"), F.floor(F.substring("thread_id", 3, 20).cast("bigint") / 12).cast("string"))
    )
    batches = threads.thread_batches(users, ["user_id"], _THREADS_PER_BATCH)
    return batches.select(
        "user_id", "thread_id", "thread_index", F.concat_ws("-", "user_id", "batch_no").alias("batch_id")
    )


_BATCHES = """
SELECT *, ROW_NUMBER() OVER (PARTITION BY batch_id ORDER BY MD5(thread_id), thread_id) AS thread_index FROM (
 SELECT user_id, conv_id, thread_id,
  user_id || '-' || CAST(CAST(FLOOR((ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY MD5(thread_id), thread_id) - 1) / 5) AS BIGINT) AS STRING) AS batch_id
 FROM (SELECT DISTINCT conv_id, 'c-' || CAST(conv_id AS STRING) AS thread_id,
  'u' || CAST(CAST(FLOOR(conv_id / 12) AS BIGINT) AS STRING) AS user_id FROM conversations) d) b"""


@query("win_6_thread_and_message_numbers", f"""
SELECT b.batch_id, b.thread_id, b.thread_index, 'c-' || CAST(c.conv_id AS STRING) || '-' || CAST(c.turn AS STRING) AS message_id,
 ROW_NUMBER() OVER (PARTITION BY c.conv_id ORDER BY c.turn) AS message_no
FROM conversations c JOIN ({_BATCHES}) b ON b.conv_id = c.conv_id""")
def win_6(t):
    numbers = threads.message_numbers(conversation_messages(t)).select("thread_id", "message_id", "message_no")
    batches = conversation_batches(t).select("batch_id", "thread_id", "thread_index")
    return numbers.join(batches, "thread_id")


_CLEAN_TURNS = clean_sql("conversations c", "conv_id, turn, role", "text")
_NUMBERED = f"""
SELECT c.*, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) AS n, COUNT(*) OVER (PARTITION BY conv_id) AS total
FROM ({_CLEAN_TURNS}) c"""
_SECTION = f"""
SELECT conv_id, MAX(total) AS total, STRING_AGG(
 '[Message ' || CAST(n AS STRING) || ']' || chr(10)
 || 'From: ' || CASE WHEN role = 'assistant' THEN 'u' || CAST(conv_id AS STRING) || '@creator.com' WHEN role = 'system' THEN 'Sys <sys@brand.com>' ELSE 'Ann <ann@brand.com>' END || chr(10)
 || 'Date: day ' || CAST(turn AS STRING) || chr(10) || 'Subject: Deal ' || CAST(conv_id AS STRING) || chr(10) || chr(10)
 || CASE WHEN clean = '' THEN '[no body]' ELSE clean END || chr(10) || chr(10), '' ORDER BY n) AS messages
FROM ({_NUMBERED}) n GROUP BY conv_id"""
_BATCH_TEXT = f"""
SELECT b.batch_id, CAST(0 AS BIGINT) AS part_no, STRING_AGG(
 'THREAD_ID_INDEX: ' || CAST(b.thread_index AS STRING) || chr(10) || 'MODE: FULL_THREAD' || chr(10)
 || 'Message Count: ' || CAST(s.total AS STRING) || chr(10) || 'PREVIOUS_AI_SUMMARY: '
 || CASE WHEN s.conv_id % 3 = 0 THEN 'earlier c-' || CAST(s.conv_id AS STRING) ELSE 'None' END || chr(10) || chr(10)
 || s.messages || '===' || chr(10), chr(10) ORDER BY b.thread_index) AS thread_data,
 COUNT(*) AS threads, CAST(SUM(s.total) AS BIGINT) AS emails, MIN(b.user_id) AS user_id
FROM ({_BATCHES}) b JOIN ({_SECTION}) s ON s.conv_id = b.conv_id GROUP BY b.batch_id"""


def conversation_texts(t):
    batches = conversation_batches(t)
    segments = threads.batch_segments(conversation_messages(t), batches.select("batch_id", "thread_id", "thread_index"))
    return threads.batch_texts(segments)


@query("txt_2_batch_texts", f"SELECT batch_id, part_no, thread_data, threads, emails FROM ({_BATCH_TEXT}) b")
def txt_2(t):
    return conversation_texts(t)


def _prompts(t):
    user = F.substring_index("batch_id", "-", 1)
    texts = conversation_texts(t).withColumns(
        {
            "creator_email": F.when(user != "u1", F.concat(user, F.lit("@creator.com"))),
            "system_prompt": threads.choose_template(
                F.when(user.isin("u2", "u3"), F.lit("Meta-LLAMA-3")).otherwise("Qwen3"),
                "default system text\n",
                "llama system text ",
                F.when(user == "u3", F.lit("own text")),
            ),
        }
    )
    return threads.user_prompts(texts, F.lit(TEMPLATE))


_PROMPT = f"""
SELECT batch_id, part_no, 'Classify these threads.' || chr(10) || chr(10)
 || CASE WHEN user_id <> 'u1' THEN 'Creator email: ' || user_id || '@creator.com' || chr(10) || chr(10) ELSE '' END
 || thread_data || chr(10) || chr(10) || 'Answer in JSON.' AS user_prompt,
 CASE WHEN user_id = 'u3' THEN 'own text' WHEN user_id = 'u2' THEN 'llama system text' ELSE 'default system text' END AS system_prompt,
 emails, threads, thread_data
FROM ({_BATCH_TEXT}) b"""


@query("txt_2b_user_prompts", f"SELECT batch_id, part_no, user_prompt FROM ({_PROMPT}) p")
def txt_2b(t):
    return _prompts(t).select("batch_id", "part_no", "user_prompt")


@query("txt_3_system_prompts", f"SELECT batch_id, part_no, system_prompt FROM ({_PROMPT}) p")
def txt_3(t):
    return _prompts(t).select("batch_id", "part_no", "system_prompt")


@query("txt_4_size_report", f"""
SELECT batch_id, emails, threads, CAST(LENGTH(system_prompt) AS BIGINT) AS system_chars,
 CAST(LENGTH(user_prompt) AS BIGINT) AS user_chars, CAST(LENGTH(thread_data) AS BIGINT) AS thread_chars FROM ({_PROMPT}) p""")
def txt_4(t):
    return threads.size_report(_prompts(t))


@query("agg_9_messages_by_thread", """
SELECT 'c-' || CAST(conv_id AS STRING) AS thread_id, CAST(FLOOR((n - 1) / 3) AS BIGINT) AS part_no,
 STRING_AGG('c-' || CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING), ',' ORDER BY n) AS message_ids
FROM (SELECT conv_id, turn, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) x
GROUP BY conv_id, 2""")
def agg_9(t):
    rows = conversation_messages(t).select("thread_id", "message_id", "position")
    parts = threads.messages_by_thread(rows, messages_per_part=3)
    return parts.select(
        "thread_id", "part_no", F.array_join(F.transform("messages", lambda m: m["message_id"]), ",").alias("message_ids")
    )


# Message sizes: id and text; parts hold what begins in one half of 4,000 bytes.
@query("agg_9b_messages_by_bytes", """
SELECT 'c-' || CAST(conv_id AS STRING) AS thread_id, part_no,
 STRING_AGG('c-' || CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING), ',' ORDER BY turn) AS message_ids
FROM (SELECT conv_id, turn, CAST(FLOOR((SUM(size) OVER (PARTITION BY conv_id ORDER BY turn) - size) / 2000) AS BIGINT) AS part_no
 FROM (SELECT conv_id, turn, OCTET_LENGTH(ENCODE('c-' || CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING)))
  + COALESCE(OCTET_LENGTH(ENCODE(text)), 0) AS size FROM conversations) s) p GROUP BY conv_id, part_no""")
def agg_9_bytes(t):
    rows = conversation_messages(t).select("thread_id", "message_id", "position", F.coalesce("body", "reply_body").alias("body"))
    parts = threads.messages_by_thread(rows, part_bytes=4000)
    return parts.select(
        "thread_id", "part_no", F.array_join(F.transform("messages", lambda m: m["message_id"]), ",").alias("message_ids")
    )


@query("sca_13_stable_ids", "SELECT SHA256('doc|' || CAST(doc_id AS STRING) || '|' || source) AS id FROM documents")
def sca_13(t):
    return t.documents.select(stable_id(F.lit("doc"), F.col("doc_id"), F.col("source")).alias("id"))
