"""Chat formatting from an event log, in DataFrame operations only.

``reconstruct`` folds a log of events into final messages:

- ``message`` opens message ``msg`` with a role and its first text;
- ``delta`` appends to it;
- ``edit`` replaces what it said so far (later deltas append to the edit);
- ``regenerate`` discards what it said so far, and the messages of the
  conversation that were opened after it and before the regeneration.

Events are ordered by sequence number; equal numbers by kind, then text. Nulls:
a null text is empty, a null role is empty, a null sequence comes first, a null
conversation is a conversation of its own. Events of a message that never
opened take the role of the first event that names one.

``render`` writes one string per conversation. Turn marks contain ``<``; texts
never do, because ``&`` and ``<`` are written as entities (roles escape ``>``
too), so a text that imitates a mark is read back unchanged. ``parse`` reads
the string back.

Messages are folded by (conversation, message) before the conversation is put
together, so only finished turns meet in a conversation's row, which is the
unit of the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EVENTS = "conv_id bigint, seq bigint, kind string, msg bigint, role string, text string"
TURN_END = "</turn>\n"
PROBE_CONV = -7                                   # fixed values of the contract
PROBE_TEXT = "\\### Assistant: </turn> ok"


def _escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(_escape(role), F.lit(">"), F.lit("&gt;"))


def _unescape_role(role: Column) -> Column:
    return _unescape(F.replace(role, F.lit("&gt;"), F.lit(">")))


def conversation_events(conversations: DataFrame) -> DataFrame:
    """An event log that leads to a table of finished turns. Rows are ordered
    by turn, then role, then text (nulls first), so repeated rows stay apart.
    Turns take three ways by their number: streamed in two parts; a draft that
    an edit replaces, then the rest; a draft that is regenerated after another
    message (with a negative number) answered it, then two parts."""
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    text = F.coalesce(F.col("text"), F.lit(""))
    half = F.floor(F.length(text) / 2).cast("int")
    first, rest, draft = F.left(text, half), F.substring(text, half + 1, F.length(text)), F.reverse(text)
    nothing = F.lit(None).cast("string")

    def event(kind, k, role=nothing, part=nothing, msg=F.col("msg")):
        return F.struct((F.col("msg") * 8 + k).alias("seq"), F.lit(kind).alias("kind"), msg.alias("msg"),
                        role.cast("string").alias("role"), part.alias("text"))

    role = F.col("role")
    streamed = F.array(event("message", 0, role, first), event("delta", 1, part=rest))
    edited = F.array(event("message", 0, role, draft), event("delta", 1, part=draft), event("edit", 2, part=first),
                     event("delta", 3, part=rest))
    regenerated = F.array(
        event("message", 0, role, draft), event("message", 1, F.lit("user"), draft, -F.col("msg")),
        event("delta", 2, part=draft, msg=-F.col("msg")), event("regenerate", 3), event("delta", 4, part=first),
        event("delta", 5, part=rest))
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn(
        "msg", F.row_number().over(order).cast("bigint"))
    way = F.pmod(F.col("msg"), F.lit(3))
    return rows.select("conv_id", "msg", F.explode(
        F.when(way == 1, streamed).when(way == 2, edited).otherwise(regenerated)).alias("e")
    ).select("conv_id", "e.seq", "e.kind", "e.msg", "e.role", "e.text")


def reconstruct(events: DataFrame) -> DataFrame:
    """conv_id, msg, start_seq, role, text of every message that remains."""
    e = events.select(
        "conv_id", "msg", "role", F.coalesce("seq", F.lit(-2**63).cast("bigint")).alias("seq"), "kind",
        F.coalesce("text", F.lit("")).alias("text"))
    resets = F.col("kind").isin("edit", "regenerate")
    folded = e.groupBy("conv_id", "msg").agg(
        F.min("seq").alias("start_seq"),
        F.max(F.when(resets, F.struct("seq", F.when(F.col("kind") == "edit", 1).otherwise(0)))).alias("reset"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("regenerated"),
        F.array_sort(F.collect_list(F.struct("seq", "kind", "text", "role"))).alias("parts"))
    after = lambda p: F.col("reset").isNull() | (p["seq"] > F.col("reset.seq")) | (
        (p["seq"] == F.col("reset.seq")) & (p["kind"] == "edit"))
    roles = F.filter(F.transform("parts", lambda p: p["role"]), lambda r: r.isNotNull())
    messages = folded.select(
        "conv_id", "msg", "start_seq", "regenerated",
        F.coalesce(F.get(roles, F.lit(0)), F.lit("")).alias("role"),
        F.array_join(F.transform(F.filter(
            "parts", lambda p: after(p) & (p["kind"] != "regenerate")), lambda p: p["text"]), "").alias("text"))
    earlier = Window.partitionBy("conv_id").orderBy("start_seq", "msg").rowsBetween(
        Window.unboundedPreceding, -1)
    gone = F.max("regenerated").over(earlier)
    return messages.withColumn("gone", gone).where(
        F.col("gone").isNull() | (F.col("gone") < F.col("start_seq"))).select(
        "conv_id", "msg", "start_seq", "role", "text")


def render(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``formatted``; ``loss_mask`` (per turn) and
    ``loss_spans`` (code point offsets of the escaped loss texts)."""
    turn = F.concat(F.lit("<turn:"), _escape_role(F.col("role")), F.lit(">"))
    body = _escape(F.col("text"))
    ordered = Window.partitionBy("conv_id").orderBy("start_seq", "msg")
    parts = messages.select("conv_id", "start_seq", "msg", "role", turn.alias("head"), body.alias("body"))
    size = F.length("head") + F.length("body") + F.lit(len(TURN_END))
    placed = parts.withColumn("ends", F.sum(size).over(
        ordered.rowsBetween(Window.unboundedPreceding, 0)))
    end = F.col("ends") - F.lit(len(TURN_END))
    loss = F.col("role").isin(*loss_roles)
    item = F.struct("start_seq", "msg", F.concat("head", "body", F.lit(TURN_END)).alias("piece"),
                    loss.alias("loss"), (end - F.length("body")).alias("start"), end.alias("end"))
    rows = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("turns"))
    return rows.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform("turns", lambda t: t["loss"]).alias("loss_mask"),
        F.transform(F.filter("turns", lambda t: t["loss"]),
                    lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))).alias("loss_spans"))


def parse(rendered: DataFrame) -> DataFrame:
    """Read ``formatted`` back: ``turns`` is an array of (role, text, loss)."""
    pieces = F.filter(F.split("formatted", TURN_END), lambda s: s != "")
    role = lambda s: F.substring_index(F.substring(s, len("<turn:") + 1, F.length(s)), ">", 1)
    text = lambda s: F.substring(s, F.length(role(s)) + len("<turn:>") + 1, F.length(s))
    return rendered.withColumn("turns", F.transform(
        F.arrays_zip(pieces.alias("piece"), F.col("loss_mask").alias("loss")),
        lambda t: F.struct(_unescape_role(role(t["piece"])).alias("role"),
                           _unescape(text(t["piece"])).alias("text"), t["loss"].alias("loss"))))


def op3_query(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    probe = spark.range(2).select(
        F.lit(PROBE_CONV).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"))
    table = conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
    back = parse(render(reconstruct(conversation_events(table))))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return back.withColumn("loss", loss).select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(digest, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


def _sql_escape(col: str) -> str:
    return f"replace(replace({col}, '&', '&amp;'), '<', '&lt;')"


OP3_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT {PROBE_CONV}, 0, 'user', '{PROBE_TEXT}'
  UNION ALL SELECT {PROBE_CONV}, 1, 'assistant', '{PROBE_TEXT}'),
numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k
  FROM rows),
folded AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY k) AS turns,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY k), '') AS loss,
         sum(length('<turn:') + length(replace({_sql_escape('role')}, '>', '&gt;')) + length('>')
             + length({_sql_escape('text')}) + {len(TURN_END)}) AS formatted_chars
  FROM numbered GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars
FROM folded
"""
