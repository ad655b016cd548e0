"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

A log holds events: ``conv_id, seq, turn, kind, role, text``. Kinds: ``message`` opens a
message, ``delta`` appends to it, ``edit`` replaces its text, ``regenerate`` throws its text away,
starts again, and voids what later turns said before it (they answered the text thrown away). The
log is partitioned by conversation, sorted by sequence and folded into final messages, which
are then rendered.

Rendering: ``<|turn|>role<|says|>text<|end|>`` per turn. Control strings inside roles and texts
get a backslash after their first character, and backslashes are doubled, so that no control
string of a text survives in the output and ``parse`` gives the texts back exactly. The loss
mask is a list of (start, length) spans in code points of the output: assistant texts.

Scale: folding and offsets are running sums in windows by conversation, which spill; an event that a
later edit or regeneration overrides is dropped before texts are gathered. Only finished messages
meet in one row, which is what one formatted string per conversation asks for. Costs are linear in the
turns of a conversation.

Edge cases: null text is empty, null role is the empty role, null turn or sequence sorts first,
rows that repeat a (conversation, turn) are messages of their own in order of the log; events of equal
sequence are ordered by turn, role and text; a delta, edit or regenerate without an opening message
opens one; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
#: Strings that chat templates use as control, none of which may pass through a text.
CONTROLS = (
    TURN, SAYS, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|begin_of_text|>", "<|eot_id|>",
    "<|start_header_id|>", "<|end_header_id|>", "<|system|>", "<|user|>", "<|assistant|>",
)


def _quoted(s: str) -> str:
    return "".join("\\" + c if c in r"\.^$|?*+()[]{}" else c for c in s)


#: First character and rest of any control string.
CONTROL_PATTERN = "([<\\[])(" + "|".join(sorted((_quoted(c[1:]) for c in CONTROLS), key=len, reverse=True)) + ")"


def escape(c: Column) -> Column:
    doubled = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL_PATTERN, r"$1\\$2")


def unescape(c: Column) -> Column:
    """Drop the backslash before any character (which may be a backslash)."""
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def fold_messages(events: DataFrame) -> DataFrame:
    """Events to final messages: conv_id, turn, msg, role, text."""
    e = events.select(
        "conv_id", "turn", "seq", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("kind", F.lit("message")).alias("kind")
    )
    e = e.withColumn("n", F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("seq").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")))
    later = Window.partitionBy("conv_id").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    turn = F.coalesce(F.col("turn").cast("bigint"), F.lit(-(2**63)))
    voided = F.min(F.when(F.col("kind") == "regenerate", turn)).over(later) < turn
    e = e.withColumn("voided", F.coalesce(voided, F.lit(False))).where(~F.col("voided")).drop("voided")
    so_far = Window.partitionBy("conv_id", "turn").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("msg", F.sum((F.col("kind") == "message").cast("int")).over(so_far))
    # the last event that sets the text anew, and the deltas after it
    message = Window.partitionBy("conv_id", "turn", "msg")
    e = e.withColumns({"last": F.max(F.when(F.col("kind") != "delta", F.col("n"))).over(message), "role": F.first("role").over(message.orderBy("n"))})
    e = e.where(F.coalesce(F.col("n") >= F.col("last"), F.lit(True)))
    parts = F.sort_array(F.collect_list(F.struct("n", "text")))
    return e.groupBy("conv_id", "turn", "msg").agg(F.first("role").alias("role"), F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """Messages to one row per conversation: conv_id, formatted, loss_spans."""
    m = messages.withColumns({"head": F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SAYS)), "body": escape(F.col("text"))})
    m = m.withColumn("size", F.length("head") + F.length("body") + len(END))
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "msg")
    m = m.withColumns({"at": F.row_number().over(w), "start": F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") + F.length("head")})
    span = F.when(F.col("role") == "assistant", F.struct("start", F.length("body").cast("bigint").alias("length")))
    m = m.select("conv_id", F.struct("at", F.concat("head", "body", F.lit(END)).alias("said")).alias("part"), span.alias("span"))
    m = m.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"), F.sort_array(F.collect_list("span")).alias("loss_spans"))
    return m.select("conv_id", F.array_join(F.transform("parts", lambda p: p["said"]), "").alias("formatted"), "loss_spans")


def parse(formatted: Column) -> Column:
    """Read turns back from a formatted string: array of (role, text)."""
    turns = F.slice(F.split(formatted, _quoted(TURN), -1), 2, 2**31 - 2)

    def turn(t: Column) -> Column:
        two = F.split(t, _quoted(SAYS), 2)
        text = F.get(two, F.lit(1))
        return F.struct(unescape(F.get(two, F.lit(0))).alias("role"), unescape(F.substring(text, F.lit(1), F.length(text) - len(END))).alias("text"))

    return F.transform(turns, turn)


def format_chats(events: DataFrame) -> DataFrame:
    """The operator: events to conv_id, formatted, loss_spans."""
    return render(fold_messages(events))


def masked_texts(formatted: DataFrame) -> DataFrame:
    """conv_id, at, text: what the loss mask covers, cut out of the formatted string and unescaped. The
    string is cut into turns first, so that no span is looked for from the start of the string."""
    by = Window.partitionBy("conv_id").orderBy("start", "kind")
    said = formatted.select("conv_id", F.posexplode(F.split("formatted", _quoted(TURN), -1)).alias("pos", "said"))
    size = F.length("said") + F.when(F.col("pos") > 0, len(TURN)).otherwise(0)
    upto = F.sum(size).over(Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    said = said.select("conv_id", (upto - F.length("said")).alias("start"), F.lit(0).alias("kind"), "said", F.lit(None).cast("bigint").alias("length"))
    spans = formatted.select("conv_id", F.explode("loss_spans").alias("s")).select("conv_id", "s.start", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("said"), "s.length")
    both = said.unionByName(spans)
    before = by.rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumns({"turn_said": F.last("said", ignorenulls=True).over(before), "turn_start": F.last(F.when(F.col("kind") == 0, F.col("start")), ignorenulls=True).over(before)})
    inside = F.substring(F.col("turn_said"), (F.col("start") - F.col("turn_start") + 1).cast("int"), F.col("length").cast("int"))
    return both.where("kind = 1").select("conv_id", F.col("start").alias("at"), unescape(inside).alias("text"))


def event_log(rows: DataFrame) -> DataFrame:
    """Finished turns as the log that would lead to them. An assistant turn: a draft, an answer of the next
    turn to the draft, the regeneration that voids both, and its text in two deltas. Any other turn: its
    first half as a message, and the edit that makes it whole."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    half = (F.length(text) / 2).cast("int")
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), role, text)
    head, tail = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.length(text))

    turn = F.col("turn").cast("bigint")
    small = F.coalesce(turn, F.lit(0)) < 2**62  # a turn after it exists

    def event(k, kind, said, turn=turn, who=role):
        return F.struct(F.lit(k).alias("k"), turn.alias("turn"), F.lit(kind).alias("kind"), who.alias("role"), said.alias("text"))

    spoken = F.array(
        event(0, "message", F.lit("a draft")), event(1, "message", F.lit("an answer to it"), F.coalesce(F.when(small, turn + 1), F.lit(0)), F.lit("user")),
        event(2, "regenerate", F.lit("")), event(3, "delta", head), event(4, "delta", tail),
    )
    spoken = F.filter(spoken, lambda e: (e["k"] != 1) | small)
    written = F.array(event(0, "message", head), event(1, "edit", text))
    e = rows.withColumn("place", F.row_number().over(w))
    e = e.select("conv_id", "place", F.explode(F.when(role == "assistant", spoken).otherwise(written)).alias("e"))
    return e.select("conv_id", (F.col("place").cast("bigint") * 8 + F.col("e.k")).alias("seq"), "e.turn", "e.kind", "e.role", "e.text")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    formatted = cut(spark, format_chats(event_log(rows.unionByName(extra))), "chats")
    back = formatted.select("conv_id", F.length("formatted").cast("bigint").alias("formatted_chars"), parse(F.col("formatted")).alias("turns"))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), "formatted_chars")
    loss = masked_texts(formatted).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "text"))).alias("parts"))
    loss = loss.select(F.col("conv_id").alias("_conv"), F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("said"))
    said = F.coalesce("said", F.lit(""))
    return back.join(loss, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", "n_turns", "turns_sha256", F.length(said).cast("bigint").alias("loss_chars"), F.sha2(said, 256).alias("loss_sha256"), "formatted_chars"
    )


_RE2 = CONTROL_PATTERN.replace("'", "''")
_ESC = f"regexp_replace(replace({{x}}, '\\', '\\\\'), '{_RE2}', '\\1\\\\\\2', 'g')"
OP1_SQL = f"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum({len(TURN) + len(SAYS) + len(END)} + length({_ESC.format(x="role")}) + length({_ESC.format(x="text")}))::BIGINT AS formatted_chars
  FROM m GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""
