"""Secret scans in SQL functions alone: patterns, and sliding-window entropy by character class.

The base patterns find assignments, access keys and hex strings. Beyond them, every run of a class's
characters that is at least as long as the class's window is a candidate: a window slides over it,
the counts of its characters change by the one that enters and the one that leaves, and with them
the sum of c log2 c, from which the window's Shannon entropy follows. Windows above the class's
limit form a span. The classes are rows of one array, which a single fold goes through. Windows that meet an allow-listed stretch are left out, and so are spans within a
base span.

Positions are code points, the end exclusive. They follow from the pieces between matches and the
matches themselves. Texts without any match, null and empty texts take the short way. Every row is
worked on by itself, so there is no shuffle, and equal rows give equal results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the contract.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN = 8
# A run of a class is a match from its first character on, so shorter ones need no try.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
KINDS = (
    "assign", "access", "hex", "entropy_hex", "entropy_base64",
    "entropy_uuid", "entropy_hex_20", "entropy_lower_20", "entropy_upper_20", "entropy_mixed_20",
)

#: Character class, window and least entropy (bits a character) of each added kind.
CLASSES = {
    "entropy_hex": ("0-9A-Fa-f", 32, 3.2),
    "entropy_base64": ("A-Za-z0-9+/_=-", 32, 4.3),
    # limits that at least 99 % of random windows of the alphabet reach (32 symbols for lower and upper)
    "entropy_uuid": ("0-9A-Fa-f-", 36, 3.3),
    "entropy_hex_20": ("0-9A-Fa-f", 20, 2.8),
    "entropy_lower_20": ("a-z0-9", 20, 3.3),
    "entropy_upper_20": ("A-Z0-9", 20, 3.3),
    "entropy_mixed_20": ("A-Za-z0-9+/_=-", 20, 3.65),
}
#: Candidates that are not just runs of the class.
FORMS = {"entropy_uuid": r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Fa-f])"}
#: What a stretch must hold besides, lest long words, numbers and hyphenated words are secrets.
NEEDS = {
    "entropy_hex_20": "^(?=.*[0-9]).*[A-Fa-f]",
    "entropy_lower_20": "^(?=.*[0-9]).*[a-z]",
    "entropy_upper_20": "[A-Z]",
    "entropy_mixed_20": "^(?=.*[a-z]).*[A-Z]",
}
#: Candidates that are known to be no secrets: placeholders, alphabets, digests of nothing.
ALLOWED = (
    r"(?i)example|sample|placeholder|dummy|x{8}|abcdefghijkl|0123456789|(.)\1{7,}"
    r"|d41d8cd98f00b204e9800998ecf8427e|da39a3ee5e6b4b0d3255bfef95601890afd80709"
    r"|e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
)
MASK = "[REDACTED]"

SPAN = "struct<start: int, kind: int, stop: int>"
NONE = f"array<{SPAN}>"
#: Spans are gathered in lists of this size first; long lists are copied seldom.
LIST = 256


def run_of(letters: str, least: int) -> str:
    return f"(?<![{letters}])[{letters}]{{{least},}}"


def candidates(kind: str) -> str:
    return FORMS.get(kind) or run_of(*CLASSES[kind][:2])


def no_spans() -> Column:
    return F.array().cast(NONE)


def no_lists() -> Column:
    return F.array().cast(f"array<{NONE}>")


def span(start: Column, kind: Column, stop: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), kind.alias("kind"), stop.cast("int").alias("stop"))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once and stands in the plan once."""
    return F.get(F.transform(F.array(value), body), 0)


def gather(items: Column, first: dict[str, Column], step, last=None) -> Column:
    """Fold an array into spans. ``step(state, item)`` gives the next state's fields and ``new``, an array of
    new spans, as one struct; ``last(state)`` the spans that are still open at the end."""

    def merge(state: Column, item: Column) -> Column:
        full = F.size(state["held"]) >= LIST
        return let(
            step(state, item),
            lambda now: F.struct(
                *(now[name].alias(name) for name in first),
                F.concat(F.when(full, no_spans()).otherwise(state["held"]), now["new"]).alias("held"),
                F.concat(state["done"], F.when(full, F.array(state["held"])).otherwise(no_lists())).alias("done"),
            ),
        )

    start = F.struct(
        *(value.alias(name) for name, value in first.items()), no_spans().alias("held"), no_lists().alias("done")
    )

    def finish(state: Column) -> Column:
        parts = [F.flatten(state["done"]), state["held"]]
        return F.concat(*parts, last(state)) if last else F.concat(*parts)

    return F.aggregate(items, start, merge, finish)


def matches(text: Column, pattern: Column) -> Column:
    """Array of (before, match): each match with the number of characters since the one before."""
    return let(
        F.regexp_extract_all(text, pattern, F.lit(0)),
        lambda found: F.zip_with(
            F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), F.length),
            found,
            lambda before, match: F.struct(before.alias("before"), match.alias("match")),
        ),
    )


def base_spans(text: Column, kind: str, pattern: str, passes=None) -> Column:
    """Spans of the matches that pass."""

    def step(state, item):
        start = state["at"] + item["before"]
        stop = start + F.length(item["match"])
        new = F.array(span(start, F.lit(KINDS.index(kind)), stop))
        if passes:
            new = F.when(passes(item["match"]), new).otherwise(no_spans())
        return F.struct(stop.alias("at"), new.alias("new"))

    return gather(matches(text, F.lit(pattern)), {"at": F.lit(0)}, step)


#: c log2 c by c.
WEIGHTS = [c * math.log2(c) if c else 0.0 for c in range(max(w for _, w, _ in CLASSES.values()) + 2)]
#: A count in a window is a character of a string with one for each code, so that a step rewrites one character.
ZERO = 32


def classes() -> Column:
    """The character classes as rows: kind, pattern, window, most (of the sum of c log2 c), needs."""
    rows = []
    for kind, (_, window, least) in CLASSES.items():
        rows.append(
            F.struct(
                F.lit(KINDS.index(kind)).alias("kind"),
                F.lit(candidates(kind)).alias("pattern"),
                F.lit(window).alias("window"),
                F.lit(window * (math.log2(window) - least)).alias("most"),
                F.lit(NEEDS.get(kind, "")).alias("needs"),
            )
        )
    return F.array(*rows)


def count_at(counts: Column, code: Column) -> Column:
    return F.ascii(F.substring(counts, code + 1, F.lit(1))) - ZERO


def counted(counts: Column, code: Column, count: Column) -> Column:
    return F.overlay(counts, F.char(count + ZERO), code + 1, F.lit(1))


def windows(start: Column, codes: Column, own: Column) -> Column:
    """Spans of a candidate's windows above the class's entropy; ``codes``: its characters' codes."""
    weights, window, kind = F.array(*map(F.lit, WEIGHTS)), own["window"], own["kind"]

    def step(state, i):
        def entered(now):
            """The character that enters is counted; the one that leaves is next."""
            up = F.get(weights, now["count"] + 1) - F.get(weights, now["count"])
            total, counts = state["total"] + up, counted(state["counts"], now["enters"], now["count"] + 1)
            return let(
                F.struct(total.alias("total"), counts.alias("counts"), now["leaves"].alias("leaves")),
                lambda x: F.when(i < window, F.struct(x["total"], x["counts"])).otherwise(
                    let(count_at(x["counts"], x["leaves"]), lambda down: F.struct(
                        (x["total"] + F.get(weights, down - 1) - F.get(weights, down)).alias("total"),
                        counted(x["counts"], x["leaves"], down - 1).alias("counts"),
                    ))
                ),
            )

        def opened(now):
            begins = i - window + 1
            high = (begins >= 0) & (now["total"] <= own["most"] + F.lit(1e-9))
            return let(
                F.struct(high.alias("high"), (high & (state["stop"] < begins)).alias("opens")),
                lambda x: F.struct(
                    now["counts"].alias("counts"),
                    now["total"].alias("total"),
                    F.when(x["opens"], begins).otherwise(state["start"]).alias("start"),
                    F.when(x["high"], i + 1).otherwise(state["stop"]).alias("stop"),
                    F.when(
                        x["opens"] & (state["stop"] > 0), F.array(span(start + state["start"], kind, start + state["stop"]))
                    ).otherwise(no_spans()).alias("new"),
                ),
            )

        moved = F.struct(F.get(codes, i).alias("enters"), F.get(codes, i - window).alias("leaves"))
        return let(
            let(moved, lambda c: let(
                F.struct(c["enters"], c["leaves"], count_at(state["counts"], c["enters"]).alias("count")), entered
            )),
            opened,
        )

    def last(state):
        open_ = F.array(span(start + state["start"], kind, start + state["stop"]))
        return F.when(state["stop"] > 0, open_).otherwise(no_spans())

    first = {"counts": F.lit(chr(ZERO) * 128), "total": F.lit(0.0), "start": F.lit(0), "stop": F.lit(0)}
    return gather(F.sequence(F.lit(0), F.size(codes) - 1), first, step, last)


def entropy_spans(text: Column, own: Column) -> Column:
    """Spans of the windows above the entropy of a class, over all of its candidates."""

    def pieces(start: Column, match: Column) -> Column:
        """Spans of what lies between allow-listed stretches."""
        skips = F.transform(F.regexp_extract_all(match, F.lit(ALLOWED), F.lit(0)), F.length)
        parts = F.zip_with(
            F.split(match, ALLOWED, -1), skips, lambda part, skip: F.struct(part.alias("part"), F.coalesce(skip, F.lit(0)).alias("skip"))
        )

        def one(state, item):
            size = F.length(item["part"])
            wanted = (size >= own["window"]) & F.regexp_like(item["part"], own["needs"])
            codes = F.transform(F.split(item["part"], "", -1), F.ascii)
            new = F.when(wanted, let(codes, lambda x: windows(state["at"], x, own))).otherwise(no_spans())
            return F.struct((state["at"] + size + item["skip"]).alias("at"), new.alias("new"))

        return gather(parts, {"at": start}, one)

    def step(state, item):
        return let(
            state["at"] + item["before"],
            lambda start: F.struct((start + F.length(item["match"])).alias("at"), pieces(start, item["match"]).alias("new")),
        )

    return gather(matches(text, own["pattern"]), {"at": F.lit(0)}, step)


def guarded(text: Column, pattern: Column, spans: Column) -> Column:
    return F.when(F.regexp_like(text, pattern), spans).otherwise(no_spans())


def scan(text: Column) -> Column:
    """Struct of two sorted arrays of spans: ``base``, and ``all`` with the added ones."""
    text = F.coalesce(text, F.lit(""))

    def assigns(match: Column) -> Column:
        return F.length(F.regexp_extract(match, ASSIGN, 2)) >= ASSIGN_MIN

    base = F.concat(
        guarded(text, F.lit(ASSIGN), base_spans(text, "assign", ASSIGN, assigns)),
        guarded(text, F.lit(ACCESS), base_spans(text, "access", ACCESS)),
        guarded(text, F.lit(HEX), base_spans(text, "hex", HEX)),
    )
    added = F.flatten(F.transform(classes(), lambda own: guarded(text, own["pattern"], entropy_spans(text, own))))
    return F.struct(F.array_sort(base).alias("base"), added.alias("added"))


def with_added(found: str) -> Column:
    """All spans of a column of ``scan``: the base ones, and the added ones that neither they nor earlier kinds hold."""
    base, added = F.col(f"{found}.base"), F.col(f"{found}.added")

    def outside(new: Column) -> Column:
        def holds(s: Column) -> Column:
            return (s["kind"] < new["kind"]) & (s["start"] <= new["start"]) & (s["stop"] >= new["stop"])

        return ~F.exists(base, holds) & ~F.exists(added, holds)

    return F.when(F.size(added) == 0, base).otherwise(F.array_sort(F.concat(base, F.filter(added, outside))))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, by start, then kind, joined by commas."""
    names = F.array(*map(F.lit, KINDS))

    def one(s: Column) -> Column:
        return F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))

    return F.array_join(F.transform(spans, one), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every stretch covered by spans, sorted by start, replaced by a mask."""

    def merge(state: Column, s: Column) -> Column:
        between = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        piece = F.when(s["start"] >= state["at"], F.array(between)).otherwise(F.array().cast("array<string>"))
        return F.struct(
            F.greatest(state["at"], s["stop"]).alias("at"), F.concat(state["pieces"], piece).alias("pieces")
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("pieces"))
    rest = F.aggregate(
        spans,
        start,
        merge,
        lambda state: F.array_join(F.concat(state["pieces"], F.array(F.expr("''"))), MASK),
    )
    at = F.array_max(F.transform(spans, lambda s: s["stop"]))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(rest, F.substring(text, at + 1, F.length(text))))
