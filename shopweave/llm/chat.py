"""Chat formatting in budgeted windows, in SQL functions alone.

A turn is written as a marked block whose texts have their control strings escaped, so that what is
written can be read back. Long conversations become several windows of whole turns. Prefix sums of the
turns' tokens, counted over range partitions so that a conversation may be of any length, cut each
conversation into stretches of bounded size; within a stretch turns fill one window after another. A
window starts with the conversation's system turn, if its first turn is one, then repeats the last turns
before it up to a limit of tokens, then has its new turns. Only new assistant turns are targets: what
is repeated is masked, so each assistant text is learned from once. A turn that is larger than a window
is a window of its own, whole.

Turns are ordered by their number, of equal numbers by role and text; repeated rows are turns each.
Nulls: a null text or role is an empty one, a null number is the first, and null conversations are one
conversation. An empty table has no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Workspace

#: Tokens of a window, of the turns repeated at its start, and of a stretch.
BUDGET, HISTORY, STRETCH = 1024, 256, 16 * 1024

# The template. A backslash stands only before the letter of what it replaces.
OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>\n"
ESCAPES = [("\\", "\\s"), ("###", "\\h"), ("</turn>", "\\t"), (": ", "\\c")]
#: A token is a run of letters and digits, or a mark; the template's marks count as so many.
TOKEN = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"
MARKS = 8
SYSTEM, ASSISTANT = "system", "assistant"


def escaped(text: Column, role: bool = False) -> Column:
    """A text without the template's control strings; of a role, without what ends it, too."""
    for plain, mark in ESCAPES if role else ESCAPES[:-1]:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescaped(text: Column) -> Column:
    for plain, mark in reversed(ESCAPES):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def formatted(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), escaped(role, True), F.lit(BETWEEN), escaped(text), F.lit(CLOSE))


def tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN)) + F.lit(MARKS)


def digest(*columns: Column) -> Column:
    """Key of some columns; nulls differ from all values."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns]
    sized = [x for p in parts for x in (F.length(p).cast("string"), p)]
    return F.unhex(F.md5(F.concat_ws(":", *sized)))


def numbered(turns: DataFrame, workspace: Workspace) -> DataFrame:
    """Narrow rows (conv, conv_id, key, role, tokens) with ``place``, the turns before, and ``before``, the
    tokens before. ``turns``: conv, conv_id, turn, role, text, key."""
    size = tokens(escaped(F.col("text")))
    narrow = turns.select("conv", "conv_id", "turn", "role", "key", size.alias("tokens"), F.monotonically_increasing_id().alias("copy"))
    order = ["turn", "role", "key", "copy"]
    ranged = narrow.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id())
    ranged = workspace.keep(ranged, "turns")
    sums = ranged.groupBy("conv", "part").agg(F.count("*").alias("n"), F.sum("tokens").alias("sum"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("conv", "part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_") for c in ("n", "sum")))
    own = Window.partitionBy("conv", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.select(
        "*", F.count("*").over(own).alias("place"), F.coalesce(F.sum("tokens").over(own), F.lit(0)).alias("before")
    ).join(starts, ["conv", "part"])
    placed = inside.select(
        "conv", "conv_id", "key", "role", "tokens",
        (F.col("place") + F.col("n_")).alias("place"), (F.col("before") + F.col("sum_")).alias("before"),
    )
    return workspace.keep(placed, "placed")


def filled(turns: Column, room: Column, budget: int) -> Column:
    """Starts of windows: the place of each turn that doesn't fit the window of those before it."""

    def step(state: Column, turn: Column) -> Column:
        fits = turn["before"] + turn["tokens"] - state["before"] <= room
        opens = state["before"].isNull() | ~fits
        return F.struct(
            F.when(opens, turn["before"]).otherwise(state["before"]).alias("before"),
            F.concat(state["starts"], F.when(opens, F.array(turn["place"])).otherwise(F.array().cast("array<bigint>"))).alias("starts"),
        )

    start = F.struct(F.lit(None).cast("bigint").alias("before"), F.array().cast("array<bigint>").alias("starts"))
    return F.aggregate(turns, start, step, lambda state: state["starts"])


def windows_of(placed: DataFrame, systems: DataFrame, workspace: Workspace, budget: int, history: int, stretch: int) -> DataFrame:
    """(conv, conv_id, first, turns): each window's first new turn, and its new turns."""
    block = F.expr(f"before div {stretch}").alias("block")
    item = F.struct("place", "before", "tokens", "key", "role")
    blocks = placed.groupBy("conv", block).agg(F.min("conv_id").alias("conv_id"), F.array_sort(F.collect_list(item)).alias("turns"))
    # the first window has no history and its system turn is new; the others hold both in reserve
    blocks = blocks.join(systems.select("conv", F.col("tokens").alias("own")), "conv", "left")
    room = F.lit(budget - history) - F.coalesce("own", F.lit(0))
    blocks = blocks.withColumn("starts", filled(F.col("turns"), room, budget))
    blocks = blocks.select("conv", "conv_id", "turns", F.posexplode("starts").alias("at", "first"), "starts")
    end = F.coalesce(F.get("starts", F.col("at") + 1), F.lit((1 << 63) - 1))
    new = F.filter("turns", lambda t: (t["place"] >= F.col("first")) & (t["place"] < end))
    return workspace.keep(blocks.select("conv", "conv_id", "first", new.alias("turns")), "windows")


def placements(placed: DataFrame, workspace: Workspace, budget: int, history: int, stretch: int) -> DataFrame:
    """(conv, conv_id, first, place, key, role, fresh): the turns of every window; ``fresh`` if not repeated."""
    systems = placed.where((F.col("place") == 0) & (F.col("role") == SYSTEM)).select("conv", "key", "role", "tokens")
    windows = windows_of(placed, systems, workspace, budget, history, stretch)
    names = ["conv", "conv_id", "first", "place", "key", "role"]
    new = windows.select("conv", "conv_id", "first", F.inline("turns"))
    new = new.select(*names, F.lit(True).alias("fresh"))
    later = windows.where("first > 0").select("conv", "conv_id", "first", F.col("turns")[0]["before"].alias("start"))
    # a turn is history of the windows that start within ``history`` tokens after it: equal or next bucket
    reach = F.expr(f"explode(array(start div {history}, start div {history} - 1))").alias("bucket")
    past = placed.select("conv", F.expr(f"before div {history}").alias("bucket"), "before", "place", "key", "role")
    past = past.where(~((F.col("place") == 0) & (F.col("role") == SYSTEM)))
    repeats = later.select("*", reach).join(past, ["conv", "bucket"])
    repeats = repeats.where((F.col("place") < F.col("first")) & (F.col("start") - F.col("before") <= history))
    repeats = repeats.select(*names, F.lit(False).alias("fresh"))
    head = later.join(systems, "conv").select("conv", "conv_id", "first", F.lit(0).cast("bigint").alias("place"), "key", "role", F.lit(False).alias("fresh"))
    return new.unionByName(repeats).unionByName(head)


def windows(
    turns: DataFrame,
    workspace: Workspace,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
    stretch: int = STRETCH,
) -> DataFrame:
    """One row a window: the conversation, ``window`` (its first new turn), ``formatted`` (text), ``repeated``
    (turns that it repeats, at its start) and ``targets``, the stretches (start, stop) of the text, in code
    points, that are under the loss mask."""
    rows = turns.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("conv", digest(F.col("conv_id"))).withColumn("key", digest(*map(F.col, ("conv_id", "turn", "role", "text"))))
    placed = placements(numbered(rows, workspace), workspace, budget, history, stretch)
    texts = rows.groupBy("key").agg(F.first("text").alias("text"))
    block = formatted(F.col("role"), F.col("text"))
    lead = F.length(F.concat(F.lit(OPEN), escaped(F.col("role"), True), F.lit(BETWEEN)))
    target = F.col("fresh") & (F.col("role") == ASSISTANT)
    parts = placed.join(texts, "key").select(
        "conv", "conv_id", "first",
        F.struct("place", "fresh", target.alias("target"), lead.alias("lead"), block.alias("block")).alias("part"),
    )
    grouped = parts.groupBy("conv", "first").agg(F.min("conv_id").alias("conv_id"), F.array_sort(F.collect_list("part")).alias("parts"))
    return grouped.select(
        F.col("conv_id").alias(conversation),
        F.col("first").alias("window"),
        F.array_join("parts.block", "").alias("formatted"),
        F.size(F.filter("parts", lambda p: ~p["fresh"])).alias("repeated"),
        spans(F.col("parts")).alias("targets"),
    )


def spans(parts: Column) -> Column:
    """(start, stop) of the targets in the joined blocks."""
    none = F.array().cast("array<struct<start: int, stop: int>>")

    def step(state: Column, part: Column) -> Column:
        end = state["at"] + F.length(part["block"])
        span = F.struct((state["at"] + part["lead"]).alias("start"), (end - len(CLOSE)).alias("stop"))
        return F.struct(end.alias("at"), F.concat(state["found"], F.when(part["target"], F.array(span)).otherwise(none)).alias("found"))

    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("found")), step, lambda state: state["found"])


def read_back(formatted_: Column) -> Column:
    """Array of (role, text) of the turns written in a window."""
    blocks = F.split(formatted_, CLOSE, -1)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def one(block: Column) -> Column:
        at = F.instr(block, BETWEEN)
        role = F.substring(block, len(OPEN) + 1, at - len(OPEN) - 1)
        return F.struct(unescaped(role).alias("role"), unescaped(F.substring(block, at + len(BETWEEN), F.length(block))).alias("text"))

    return F.transform(blocks, one)


def learned(formatted_: Column, targets: Column) -> Column:
    """Array of the texts under the loss mask, unescaped."""
    return F.transform(targets, lambda s: unescaped(F.substring(formatted_, s["start"] + 1, s["stop"] - s["start"])))
