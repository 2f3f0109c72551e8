"""Chat formatting from an event log.

A conversation's log has ``message`` (a turn begins), ``delta`` (text streamed
to a turn), ``edit`` (a turn's text is replaced) and ``regenerate`` (a turn is
written anew, and what followed it goes). Events before a regeneration of an
earlier turn are dead; each turn's live events, in sequence, are folded into
its final message; the messages of a conversation, in turn order, are rendered
with a loss mask over the assistant's texts.

The template is ``<s>[INST]role[/INST]text</s>`` per turn. In roles and texts a
backslash is doubled and one follows every ``<`` and ``[``, so no control
string can occur inside them and the text between two of them reads back
exactly.

Only DataFrame functions are used. The log is shuffled by turn, and a hot
conversation's turns are folded by many tasks; only its finished record, one
string, is put together in one place. Defined results: null texts and roles
are empty; a null conversation is one of its own; null sequence numbers and
turns come first; events of a turn with equal sequence numbers are ordered by
event, role and text; unknown events are ignored; empty tables give no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .kernels import pick

TURN, ROLE_END, TURN_END = "<s>[INST]", "[/INST]", "</s>"
RESETS = ("message", "edit", "regenerate")


def escape(text: Column) -> Column:
    for sign in ("\\", "<", "["):
        text = F.replace(text, F.lit(sign), F.lit(sign + "\\"))
    return text


def unescape(text: Column) -> Column:
    for sign in ("[", "<", "\\"):
        text = F.replace(text, F.lit(sign + "\\"), F.lit(sign))
    return text


def fold_events(events: DataFrame) -> DataFrame:
    """Messages (conv_id, turn, role, text) of a log (conv_id, seq, turn, event, role, text)."""
    log = pick(events, "conv_id", "seq", "turn", "event", "role", "text").where(
        F.col("event").isin(*RESETS, "delta"))
    again = log.where("event = 'regenerate'").select(
        F.col("conv_id").alias("_conv"), F.col("seq").alias("_seq"), F.col("turn").alias("_turn"))
    dead = (F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_seq") > F.col("seq"))
            & (F.col("_turn") > F.col("turn")).eqNullSafe(F.lit(False))
            & ~F.col("_turn").eqNullSafe(F.col("turn")))
    live = log.join(again, dead, "left_anti")
    event = F.struct("seq", "event", F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"), F.col("role").isNotNull().alias("named"))
    turns = live.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list(event)).alias("log"))
    # The text since the last reset.
    last = F.greatest(F.array_max(F.transform("log", lambda e, i: F.when(e["event"].isin(*RESETS), i))), F.lit(0))
    since = F.slice("log", F.coalesce(last, F.lit(0)) + 1, F.size("log"))
    role = F.element_at(F.filter("log", lambda e: e["named"])["role"], -1)
    return turns.select("conv_id", "turn", F.when(F.exists("log", lambda e: e["named"]), role).otherwise("").alias("role"),
                        F.array_join(F.transform(since, lambda e: e["text"]), "").alias("text"))


def render(messages: DataFrame, trained: str = "assistant") -> DataFrame:
    """conv_id, formatted and loss_spans: of every text of role ``trained`` the
    index and start of its turn, and its own start and length in ``formatted``."""
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(ROLE_END))
    m = messages.select("conv_id", "turn", F.col("role") == trained, head.alias("head"),
                        escape(F.col("text")).alias("body"))
    m = m.toDF("conv_id", "turn", "trained", "head", "body")
    size = F.length("head") + F.length("body") + F.lit(len(TURN_END))
    order = Window.partitionBy("conv_id").orderBy("turn")
    m = (m.withColumn("index", F.row_number().over(order) - 1)
          .withColumn("turn_start", F.sum(size.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - size))
    span = F.struct("index", "turn_start", (F.col("turn_start") + F.length("head")).alias("start"),
                    F.length("body").cast("long").alias("length"))
    part = F.struct("index", F.concat("head", "body", F.lit(TURN_END)).alias("text"))
    return m.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("parts"),
                                    F.sort_array(F.collect_list(F.when(F.col("trained"), span))).alias("loss_spans")) \
            .select("conv_id", F.array_join(F.col("parts.text"), "").alias("formatted"), "loss_spans")


def read_back(rendered: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role and text of each) and loss_text, all from the rendered form."""
    turns = F.slice(F.split("formatted", TURN_END), 1, F.greatest(F.size(F.split("formatted", TURN_END)) - 1, F.lit(0)))
    inner = rendered.withColumn("_turns", turns)
    sides = F.transform("_turns", lambda t: F.split(F.substr(t, F.lit(len(TURN) + 1)), r"\[/INST\]"))
    turn = F.transform(sides, lambda x: F.struct(unescape(x[0]).alias("role"), unescape(x[1]).alias("text")))
    masked = F.transform("loss_spans", lambda s: unescape(F.substr(
        F.get("_turns", s["index"]), (s["start"] - s["turn_start"] + 1).cast("int"), s["length"].cast("int"))))
    return inner.select("conv_id", "formatted", turn.alias("turns"), F.array_join(masked, "").alias("loss_text"))


def conversation_events(conversations: DataFrame, chunk: int = 256) -> DataFrame:
    """The log of a finished table (conv_id, turn, role, text): a message per
    row and its text as deltas of ``chunk`` characters. Rows with equal turns
    are turns of their own, ordered by role and text."""
    c = pick(conversations, "conv_id", "turn", "role", "text").select("conv_id", "turn", F.col("role").cast("string"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    same = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    c = c.withColumn("turn", F.struct("turn", F.row_number().over(same).alias("copy")))
    # One pass over the text, however long.
    pieces = F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0)))
    deltas = F.transform(pieces, lambda x, k: F.struct(
        (k + 1).cast("long").alias("seq"), F.lit("delta").alias("event"), F.lit(None).cast("string").alias("role"),
        x.alias("text")))
    begin = F.array(F.struct(F.lit(0).cast("long").alias("seq"), F.lit("message").alias("event"),
                             F.coalesce("role", F.lit("")).alias("role"), F.lit("").alias("text")))
    return c.select("conv_id", "turn", F.inline(F.concat(begin, deltas)))


def format_digests(rendered: DataFrame) -> DataFrame:
    r = read_back(rendered)
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return r.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(spoken, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
                    F.sha2("loss_text", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"))
