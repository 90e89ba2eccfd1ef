"""Chat formatting with a grammar round trip, in DataFrame functions only.

Grammar of a rendered conversation::

    conversation := turn*
    turn         := "<s>[INST]" role "\\n" text "[/INST]</s>"     (assistant: loss on text)

Control strings are ``<s>``, ``</s>``, ``[INST]`` and ``[/INST]``.  A text is escaped by putting
one backslash after the first character of every control string, whether or not it already
has some (``</s>`` to ``<\\/s>``, ``<\\/s>`` to ``<\\\\/s>``); the parser takes one away.  Roles are escaped
alike, and their line breaks become ``<n>``, which is a control string in roles.

Turns are first rendered as they are, reparsed, and compared with the source; those that differ
are escaped and rendered again, and the result is reparsed and compared as a whole
(``round_trip``).  The parser splits at ``<s>[INST]``, which an escaped text cannot hold.

Defined cases: null text and null role count as empty; turns are ordered by ``turn`` (null first),
then role and text, repeated rows kept; a null ``conv_id`` is one conversation; a role is the
text up to the first line break (its own are escaped); extra columns are ignored; an empty
table gives an empty result.  A conversation is one row in the result, as its
digests need it whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END = "<s>[INST]", "[/INST]</s>"


def escape(text: Column) -> Column:
    """One more backslash after the first character of every (escaped) control string."""
    once = F.regexp_replace(text, r"<(\\*)(/?s>)", r"<\\$1$2")
    return F.regexp_replace(once, r"\[(\\*)(/?INST\])", r"[\\$1$2")


def unescape(text: Column) -> Column:
    once = F.regexp_replace(text, r"<\\(\\*/?s>)", "<$1")
    return F.regexp_replace(once, r"\[\\(\\*/?INST\])", "[$1")


def escape_role(role: Column) -> Column:
    return F.replace(F.regexp_replace(escape(role), r"<(\\*)n>", r"<\\$1n>"), F.lit("\n"), F.lit("<n>"))


def unescape_role(role: Column) -> Column:
    lines = F.regexp_replace(role, "<n>", "\n")
    return unescape(F.regexp_replace(lines, r"<\\(\\*n>)", "<$1"))


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(BEGIN), role, F.lit("\n"), text, F.lit(END))


def parse(rendered: Column) -> Column:
    """array<struct<role, text>> of a rendered conversation.  Cuts at every BEGIN; what is cut
    must end with END, which is taken off, and hold no other control string; the role ends at
    the first line break.  A turn that breaks a rule has null role and text."""
    cut = F.split(rendered, r"<s>\[INST\]", -1)
    parts = F.slice(cut, 2, F.size(cut))

    def turn(part: Column) -> Column:
        inner = part.substr(F.lit(1), F.length(part) - len(END))
        body = F.when(part.endswith(END) & ~inner.rlike(r"</?s>|\[/?INST\]"), inner)
        at = F.locate("\n", body)
        return F.struct(unescape_role(body.substr(F.lit(1), at - 1)).alias("role"),
                        unescape(body.substr(at + 1, F.length(body))).alias("text"))

    return F.transform(parts, turn)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``recovered`` (turns read back from
    ``formatted``) and ``round_trip`` (whether they equal the source)."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    # round one, per turn: as it is; it stands if the parser gives back that one turn
    plain = F.array(F.struct("role", "text"))
    kept = parse(render(F.col("role"), F.col("text"))) == plain
    escaped = render(escape_role(F.col("role")), escape(F.col("text")))
    turns = turns.withColumn("rendered", F.when(F.coalesce(kept, F.lit(False)), render(F.col("role"), F.col("text")))
                             .otherwise(escaped))
    whole = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "rendered"))).alias("t"))
    source = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    joined = whole.select("conv_id", source.alias("source"), F.array_join("t.rendered", "").alias("formatted"))
    read = joined.select("conv_id", "source", "formatted", parse(F.col("formatted")).alias("recovered"))
    return read.select("conv_id", "formatted", "recovered", (F.col("recovered") == F.col("source")).alias("round_trip"))


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what was read back from the formatted text."""
    lines = F.array_join(F.transform("recovered", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("recovered", lambda x: x["role"] == "assistant"), lambda x: x["text"]), "")
    return formatted.select(
        "conv_id", F.size("recovered").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "round_trip")
