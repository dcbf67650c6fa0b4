"""Chat formatting: a declarative template, a state machine over roles, loss segments (native).

A :class:`Template` names the roles, the marker that opens each role's turn,
the marker that closes a turn, which roles are trained on, and the transitions
a valid conversation takes. Everything is a DataFrame expression:

* The machine reads the roles of a conversation in turn order. Its state is
  the last role (``start`` before the first, ``dead`` after an illegal one);
  ``valid`` tells whether it ends in an accepting state.
* Texts are escaped so that no text can forge a marker: the escape character
  itself is doubled and every marker inside a text is broken up by it. The
  mapping is reversible whatever the text.
* ``segments`` are the pieces of the output in order, each with its ``loss``
  flag: a trained turn's text is one loss segment, markers and other turns are
  not. ``formatted`` is their concatenation.

:func:`read_back` parses ``formatted`` alone into turns, so a round trip proves
the format; :func:`loss_text` reads the loss mask.

Turns of a conversation are gathered by conversation id; a conversation is one
training example and has to fit a row.

Defined results: null texts are empty; null roles are the empty role, which no
template knows, so the conversation is invalid (it is still formatted, under
the ``other`` marker, and read back); turns are ordered by turn, role and
text, nulls first, so ties are deterministic; repeated rows are turns of their
own; rows with a null conv_id are one conversation; an empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What a chat format is made of."""

    open: dict[str, str] = field(default_factory=lambda: {
        "system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "})
    #: Opens a turn of a role not named above; the role follows as hexadecimal, up to ``role_end``.
    other: str = "### Role "
    role_end: str = ": "
    close: str = " </turn>\n"
    escape: str = "\\"
    loss: tuple[str, ...] = ("assistant",)
    #: state -> roles that may come next; the state is the last role.
    next: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    accept: tuple[str, ...] = ("assistant",)

    #: Every marker holds one of these; an escaped text holds them broken up only.
    controls: tuple[str, ...] = ("#", "</turn>")


DEFAULT = Template()


def escape(text: Column, t: Template) -> Column:
    """Double the escape character, then put one before the end of every control string."""
    out = F.replace(text, F.lit(t.escape), F.lit(t.escape + t.escape))
    for c in t.controls:
        out = F.replace(out, F.lit(c), F.lit(c[:-1] + t.escape + c[-1]))
    return out


def unescape(text: Column, t: Template) -> Column:
    """The inverse of :func:`escape`: an escape character stands for what follows it."""
    # A doubled escape is one; a single one in front of anything else goes.
    e = "\\\\" if t.escape == "\\" else t.escape
    return F.regexp_replace(text, f"(?s){e}(.)", "$1")


def _turns(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its turns as an ordered array of (role, text)."""
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    return conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def final_state(roles: Column, t: Template) -> Column:
    """The machine's state after an array of roles."""
    def step(state: Column, role: Column) -> Column:
        out = F.lit("dead")
        for source, targets in t.next.items():
            out = F.when((state == source) & role.isin(*targets), role).otherwise(out)
        return out
    return F.aggregate(roles, F.lit("start"), step)


def _opening(role: Column, t: Template) -> Column:
    out = F.concat(F.lit(t.other), _role_text(role), F.lit(t.role_end))
    for name, marker in t.open.items():
        out = F.when(role == name, F.lit(marker)).otherwise(out)
    return out


def _role_text(role: Column) -> Column:
    """An unknown role as hexadecimal: it can hold no control string."""
    return F.lower(F.hex(F.encode(role, "UTF-8")))


def format_chats(conversations: DataFrame, t: Template = DEFAULT) -> DataFrame:
    """(conv_id, n_turns, valid, segments, formatted) of every conversation.

    ``segments`` is an array of (text, loss); a loss segment holds the escaped
    text of a trained turn and nothing else.
    """
    turns = _turns(conversations)
    pieces = F.flatten(F.transform("turns", lambda x: F.array(
        F.struct(_opening(x["role"], t).alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(x["text"], t).alias("text"), x["role"].isin(*t.loss).alias("loss")),
        F.struct(F.lit(t.close).alias("text"), F.lit(False).alias("loss")))))
    state = final_state(F.transform("turns", lambda x: x["role"]), t)
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        state.isin(*t.accept).alias("valid"), pieces.alias("segments")).withColumn(
        "formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: Column, t: Template = DEFAULT) -> Column:
    """The turns of a formatted conversation as an array of (role, text), read from the string alone."""
    # Unescaped markers occur only where the formatter put them.
    bodies = F.filter(F.split(formatted, _quote(t.close)), lambda x: x != "")

    def parse(body: Column) -> Column:
        after = F.substring_index(F.substr(body, F.lit(len(t.other) + 1)), t.role_end, 1)
        role = F.decode(F.unhex(after), "UTF-8")
        text = F.substr(body, F.length(after) + len(t.other) + len(t.role_end) + 1)
        for name, marker in t.open.items():
            role = F.when(F.startswith(body, F.lit(marker)), F.lit(name)).otherwise(role)
            text = F.when(F.startswith(body, F.lit(marker)),
                          F.substr(body, F.lit(len(marker) + 1))).otherwise(text)
        return F.struct(role.alias("role"), unescape(text, t).alias("text"))

    return F.transform(bodies, parse)


def _quote(literal: str) -> str:
    return "\\Q" + literal + "\\E"


def loss_text(segments: Column, t: Template = DEFAULT) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    trained = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(trained, lambda s: unescape(s["text"], t)), "")


def digests(formatted: DataFrame, t: Template = DEFAULT) -> DataFrame:
    """What :func:`format_chats` holds, read back from its output."""
    turns = read_back(F.col("formatted"), t)
    back = formatted.select("conv_id", "valid", "formatted", turns.alias("turns"),
                            loss_text(F.col("segments"), t).alias("loss"))
    plain = F.array_join(F.transform(
        "turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(plain, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


def sample_conversation(conversations: DataFrame) -> DataFrame:
    """Conversation -7: two turns whose texts hold control strings."""
    tricky = "\\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)]
    return conversations.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def query(conversations: DataFrame) -> DataFrame:
    """The digest columns of all conversations and of conversation -7."""
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return digests(format_chats(rows.unionByName(sample_conversation(conversations))))


QUERY_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn>', '</turn\>') AS escaped,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
  FROM rows),
stepped AS (
  SELECT *, length(escaped) + length(' </turn>' || chr(10))
         + CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15
           ELSE 11 + 2 * strlen(role) END AS chars,
         CASE WHEN before IS NULL THEN role IN ('system', 'user')
              WHEN before IN ('system', 'assistant') THEN role = 'user'
              WHEN before = 'user' THEN role = 'assistant' ELSE false END AS legal
  FROM marked)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars,
       bool_and(legal) AND arg_max(role, (turn, role, text)) = 'assistant' AS valid
FROM stepped GROUP BY conv_id
"""
