"""Chat formatting under a token budget, in DataFrame operations only.

A conversation's turns become windows of at most BUDGET tokens. Prefix sums of turn
tokens choose turn-aligned spans: a new window opens before the turn whose end would
pass the room that the system turn and the repeated history leave. Every window
starts with the system turn (when the conversation has one in front), repeats the
last turns that fit into HISTORY tokens, then has its own turns. The loss mask covers
assistant texts among a window's own turns only, so repeated targets are masked off
and every assistant text is a target exactly once. A turn larger than the room gets a
window of its own, whole.

Tokens of a turn are what the caller counts (`tokens`, an expression over the turns, as a
column that a tokeniser made); by default an estimate of one for four bytes.

Template: <s>ROLE newline TEXT </s> per turn, joined without separators. In roles and
texts & < [ are written &amp; &lt; &lsb;, in roles line ends &nl;, so no control string can
occur in them, and unescape() gives the text back.

Defined cases: null text is empty; a null role is empty; rows are ordered by turn
(null first), then role and text; a null conv_id is one conversation; rows that repeat
stay, in that order; an empty table gives no rows; other columns are ignored. The
output of a conversation holds all its text, so one conversation must fit a task; many
conversations that are alike share nothing and no key but conv_id is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from korvane.session import pick

#: Tokens of a window, and of those at most this many for repeated turns.
BUDGET, HISTORY = 1024, 256
#: Tokens a turn's marks cost.
MARKS = 6
OPEN, CLOSE = "<s>", "</s>"


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(c, F.lit("<"), F.lit("&lt;")), F.lit("["), F.lit("&lsb;"))


def unescape(c: Column) -> Column:
    c = F.replace(F.replace(c, F.lit("&lsb;"), F.lit("[")), F.lit("&lt;"), F.lit("<"))
    return F.replace(F.replace(c, F.lit("&nl;"), F.lit("\n")), F.lit("&amp;"), F.lit("&"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("&nl;"))


def estimated(text: Column) -> Column:
    """Tokens of a text as a byte-pair vocabulary counts on average: one for four bytes."""
    return F.ceil(F.octet_length(F.coalesce(text, F.lit(""))) / 4)


def _let(value: Column, body) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _prefix(a: Column) -> Column:
    """Inclusive prefix sums of an array of longs."""
    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("all"))
    return F.aggregate(a, zero, lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.concat(s["all"], F.array(s["sum"] + x)).alias("all")))["all"]


def format_chat(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: Column | None = None) -> DataFrame:
    """A row per window: conv_id, window, formatted, repeated, targets.

    tokens: the tokens of a turn's text, an expression over turns (default: estimated).
    repeated: how many turns at the front were shown before (for the first window 0).
    targets: (start, length) in characters of formatted, the loss mask.
    """
    none = F.lit("")
    counted = turns if tokens is None else turns.withColumn("__tokens", tokens)
    names = ["conv_id", "turn", "role", "text"] + ["__tokens"] * (tokens is not None)
    rows = pick(counted, *names)
    cost = (estimated(F.col("text")) if tokens is None else F.coalesce("__tokens", F.lit(0))).cast("long") + F.lit(MARKS)
    rows = rows.select("conv_id", "turn", F.coalesce("role", none).alias("role"), F.coalesce("text", none).alias("text"), cost.alias("cost"))
    # Prefix sums of the tokens; equal rows are told apart by them, so the array has the window's order.
    so_far = Window.partitionBy("conv_id").orderBy("turn", "role", "text", "cost").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.sum("cost").over(so_far))
    conv = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "end"))).alias("turns"))
    has_system = F.col("turns")[0]["role"] == "system"
    room = F.greatest(F.lit(budget) - F.lit(history) - F.when(has_system, F.col("turns")[0]["end"]).otherwise(0), F.lit(1))
    conv = conv.withColumns({"system": F.when(has_system, 1).otherwise(0), "room": room, "ends": F.transform("turns", lambda t: t["end"])})

    # Own turns of windows: a fold over the prefix sums; spans are (from, to), to not included, counted from 0.
    start = F.struct(F.lit(0).alias("first"), F.lit(0).cast("long").alias("base"), F.array().cast("array<struct<a:int,b:int>>").alias("spans"))

    def step(s: Column, i: Column) -> Column:
        end, before = F.get("ends", i), F.when(i > 0, F.get("ends", i - 1)).otherwise(0)
        # The system turn is paid for by every window, so the first span may carry it on top of its room.
        full = (end - s["base"] > F.col("room")) & (i > s["first"]) & ~((F.col("system") == 1) & (i == 1))
        return F.when(full, F.struct(i.alias("first"), before.alias("base"), F.concat(s["spans"], F.array(F.struct(s["first"].alias("a"), i.alias("b")))).alias("spans"))).otherwise(s)

    n = F.size("turns")
    fold = F.aggregate(F.sequence(F.lit(0), n - 1), start, step, lambda s: F.concat(s["spans"], F.array(F.struct(s["first"].alias("a"), n.alias("b")))))
    conv = conv.withColumn("spans", fold)

    def window(s: Column, i: Column) -> Column:
        """Its turns alone: a row of a window does not carry the conversation."""
        a, b, head = s["a"], s["b"], F.when(i > 0, F.col("system")).otherwise(0)
        # History: the longest run of turns before the span within the history budget; each costs MARKS at least.
        first = F.greatest(a - F.lit(history // MARKS + 1), F.least(a, F.col("system")))
        before = F.get("ends", a - 1)
        fits = F.filter(F.sequence(first, a), lambda k: (k == a) | (before - F.when(k > 0, F.get("ends", k - 1)).otherwise(0) <= history))
        shown = lambda f: F.concat(F.slice("turns", F.lit(1), head), F.slice("turns", f + 1, b - f))
        return _let(F.when(i == 0, a).otherwise(F.array_min(fits)), lambda f: F.struct((head + a - f).alias("repeated"), shown(f).alias("shown")))

    won = conv.select("conv_id", F.posexplode(F.transform("spans", window)).alias("window", "w")).select("conv_id", "window", "w.repeated", "w.shown")
    won = won.withColumn("parts", F.transform("shown", lambda t: F.struct(F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"))))
    ends = _prefix(F.transform("parts", lambda p: (F.length(p["head"]) + F.length(p["body"]) + len(CLOSE)).cast("long")))
    won = won.withColumn("stops", ends)
    target = F.transform(
        F.filter(F.sequence(F.lit(0), F.size("shown") - 1), lambda i: (i >= F.col("repeated")) & (F.get("shown", i)["role"] == "assistant")),
        lambda i: F.struct(
            (F.get("stops", i) - len(CLOSE) - F.length(F.get("parts", i)["body"])).cast("int").alias("start"), F.length(F.get("parts", i)["body"]).alias("length")
        ),
    )
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    return won.select("conv_id", "window", text.alias("formatted"), "repeated", target.alias("targets"))


def read_back(windows: DataFrame) -> DataFrame:
    """windows plus turns (role, text of the turns first shown there) and loss (texts under the mask), parsed from formatted alone."""
    pieces = F.slice(F.split("formatted", OPEN), F.col("repeated") + 2, F.size(F.split("formatted", OPEN)))
    turns = F.transform(
        pieces,
        lambda p: F.struct(unescape(F.substring_index(p, "\n", 1)).alias("role"), unescape(p.substr(F.instr(p, "\n") + 1, F.length(p) - F.instr(p, "\n") - len(CLOSE))).alias("text")),
    )
    loss = F.transform("targets", lambda t: unescape(F.col("formatted").substr(t["start"] + 1, t["length"])))
    return windows.withColumns({"turns": turns, "loss": loss})


def chat_report(turns: DataFrame) -> DataFrame:
    """The digests of the contract, all from what read_back() finds in the formatted windows."""
    w = read_back(format_chat(turns))
    per = w.select(
        "conv_id", "window", F.size("turns").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        F.array_join("loss", "").alias("loss"), F.length("formatted").alias("chars"),
    )
    all_ = per.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows"), F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("w")
    )
    loss = F.array_join(F.col("w.loss"), "")
    return all_.select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2(F.array_join(F.col("w.turns"), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"), "n_windows",
    )


_ESC = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '[', '&lsb;')"
_ROLE = f"replace({_ESC.format('role')}, chr(10), '&nl;')"
#: The report over `conversations` and conversation -7.
ORACLE = f"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) AS x(conv_id, turn, role, text)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i, CAST(ceil(octet_length(encode(text)) / 4) AS BIGINT) + {MARKS} AS tok,
    {len(OPEN) + len(CLOSE) + 1} + length({_ROLE}) + length({_ESC.format('text')}) AS chars FROM c),
p AS (
  SELECT *, sum(tok) OVER (PARTITION BY conv_id ORDER BY i) AS e, CASE WHEN first_value(role) OVER (PARTITION BY conv_id ORDER BY i) = 'system' THEN 1 ELSE 0 END AS sys,
    first_value(tok) OVER (PARTITION BY conv_id ORDER BY i) AS s_tok, first_value(chars) OVER (PARTITION BY conv_id ORDER BY i) AS s_chars FROM r),
w AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, CAST(0 AS HUGEINT) AS base, 0 AS win, CAST(0 AS BIGINT) AS first FROM p WHERE i = 0
  UNION ALL
  SELECT conv_id, i, CASE WHEN full_ THEN e - tok ELSE base END, CASE WHEN full_ THEN win + 1 ELSE win END, CASE WHEN full_ THEN i ELSE first END
  FROM (SELECT p.conv_id, p.i, p.e, p.tok, w.base, w.win, w.first, p.e - w.base > greatest({BUDGET - HISTORY} - p.sys * p.s_tok, 1) AND NOT (p.sys = 1 AND p.i = 1) AS full_
    FROM w JOIN p ON p.conv_id = w.conv_id AND p.i = w.i + 1)),
again AS (
  SELECT a.conv_id, a.win, max(p.sys * p.s_chars) + coalesce(sum(CASE WHEN p.i >= p.sys AND a.base - (p.e - p.tok) <= {HISTORY} THEN p.chars END), 0) AS chars
  FROM (SELECT DISTINCT conv_id, win, first, base FROM w WHERE win > 0) a JOIN p ON p.conv_id = a.conv_id AND p.i < a.first GROUP BY a.conv_id, a.win),
n AS (SELECT conv_id, CAST(max(win) + 1 AS BIGINT) AS n_windows FROM w GROUP BY conv_id),
m AS (SELECT conv_id, sum(chars) AS chars FROM again GROUP BY conv_id)
SELECT p.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(length(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant')), 0) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(p.chars) + coalesce(max(m.chars), 0) AS BIGINT) AS formatted_chars, max(n_windows) AS n_windows
FROM p JOIN n ON n.conv_id = p.conv_id LEFT JOIN m ON m.conv_id = p.conv_id GROUP BY p.conv_id
"""
