"""Secret scans: base patterns plus sliding-window entropy, with built-ins only.

A document's matches come from its own text alone, so the operator is one map
over the scan, without shuffle, join or user function.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverwatch.llm.common import bind, free_name, table

# The base patterns, their least lengths, and their order.
KEY_WORDS = ("password", "passwd", "secret", "token", "api_?key")
VALUE = "[A-Za-z0-9+/_.=-]+"
KINDS = ("assign", "access", "hex")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16


def _either_case(word: str) -> str:
    """Letters in either case, spelled out: (?i) also folds beyond ASCII in some engines."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


KEY = "(?:" + "|".join(map(_either_case, KEY_WORDS)) + ")"
ASSIGN_HEAD = KEY + "[\"']?\\x20*[:=]\\x20*[\"']?"
ASSIGN = ASSIGN_HEAD + VALUE
ACCESS = "AKIA[A-Z0-9]{%d,}" % (MIN_ACCESS - 4)
HEX = "[0-9a-f]{%d,}" % MIN_HEX


class EntropyClass(NamedTuple):
    """Candidates of one character class, judged by windows of ``window`` characters.

    A candidate counts when some window's Shannon entropy is at least ``least``
    bits per character.
    """

    kind: str
    pattern: str
    alphabet: str
    window: int
    least: float


#: One class after the other; a candidate holds the class's characters only.
CLASSES = (
    EntropyClass("entropy_hex", "[0-9A-Fa-f]{20,}", "0123456789abcdef", 20, 2.8),
    EntropyClass("entropy_base64", "[A-Za-z0-9+/_-]{24,}",
                 "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 24, 3.8),
)
#: Candidates that are no secrets: words and identifiers without digits, plain numbers,
#: dates and counters, sample keys.
ALLOW = (
    "^[A-Za-z+/_-]*$",
    "^[0-9+/_-]*$",
    "^[A-Fa-f]+$",
    "EXAMPLE|example|XXXX|xxxx",
    "^(.)\\1+$",
)
#: A candidate cut at its separators is a path or slug if each part is like this. Not one
#: pattern with a repeated group: Java matches that by recursion, as deep as there are parts.
SEPARATOR = "[+/_-]"
SLUG_PART = "^[A-Za-z]*[0-9]{0,4}$"
SCALE = 1_000_000  # entropies are summed as whole millionths, so no rounding drifts


def _blocks(values: Column, body) -> Column:
    """``body`` of each stretch of about sqrt(n) of the n (one or more) ``values``, as an array."""
    each = F.ceil(F.sqrt(F.size(values))).cast("int")
    count = F.ceil(F.size(values) / each).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1),
                       lambda b: body(F.slice(values, b * each + 1, each), b))


def _running(values: Column, op) -> Column:
    """The running ``op`` (from 0) of an array of one or more integers.

    An array that grows in a fold is copied at each step, so the fold runs over
    blocks: n numbers cost n * sqrt(n) steps.
    """
    def fold(items: Column, start: Column) -> Column:
        first = F.struct(start.alias("at"), F.array().cast("array<int>").alias("all"))

        def step(acc: Column, x: Column) -> Column:
            return bind(op(acc["at"], x), lambda now: F.struct(
                now.alias("at"), F.concat(acc["all"], F.array(now)).alias("all")))

        return F.aggregate(items, first, step, lambda a: a["all"])

    def joined(v: Column) -> Column:
        totals = _blocks(v, lambda part, b: F.aggregate(part, F.lit(0), op))
        return bind(fold(totals, F.lit(0)), lambda upto: F.flatten(_blocks(
            v, lambda part, b: fold(part, F.when(b > 0, F.get(upto, b - 1)).otherwise(F.lit(0))))))

    return bind(values, joined)


def _located(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as structs (start, end, found), in code points."""
    lit = F.lit(pattern)
    found = F.regexp_extract_all(text, lit, F.lit(0))
    parts = F.split(text, pattern, -1)

    def walk(m: Column, p: Column) -> Column:
        ends = _running(F.transform(m, lambda x, i: F.length(p[i]) + F.length(x)), lambda a, x: a + x)
        return bind(ends, lambda e: F.transform(m, lambda x, i: F.struct(
            (e[i] - F.length(x)).alias("start"), e[i].alias("end"), x.alias("found"))))

    none = F.array().cast("array<struct<start:int,end:int,found:string>>")
    return bind(found, lambda m: F.when(F.size(m) == 0, none).otherwise(
        bind(parts, lambda p: walk(m, p))))


def _only_if(test: Column, hits: Column) -> Column:
    none = F.array().cast("array<struct<start:int,end:int,found:string>>")
    return F.when(test, hits).otherwise(none)


def _is_slug(found: Column, part: str) -> Column:
    return found.rlike(SEPARATOR) & F.forall(F.split(found, SEPARATOR, -1), lambda p: p.rlike(part))


def _max_entropy_reached(s: Column, cls: EntropyClass) -> Column:
    """Whether some window of ``s`` reaches the class's entropy.

    The state holds the count of each character in the window and the sum of
    c * log2(c) over the counts; a step adds one character and removes one.
    H = log2(window) - sum / window.
    """
    terms = [round(SCALE * c * math.log2(c)) if c else 0 for c in range(cls.window + 2)]
    most = math.floor(SCALE * cls.window * (math.log2(cls.window) - cls.least))
    f = F.array(*[F.lit(x).cast("long") for x in terms])
    folded = F.lower(s) if cls.alphabet == cls.alphabet.lower() else s
    codes = F.transform(F.split(folded, "", -1),
                        lambda c: F.instr(F.lit(cls.alphabet), c) - 1)
    # split on "" leaves an empty last part, which is in no class
    codes = F.filter(F.slice(codes, 1, F.length(s)), lambda c: c >= 0)

    def over(code: Column, table_: Column) -> Column:
        start = F.struct(
            F.array_repeat(F.lit(0), len(cls.alphabet)).alias("n"),
            F.lit(0).cast("long").alias("sum"), F.lit(False).alias("hit"))

        def step(acc: Column, i: Column) -> Column:
            came = code[i]
            gone = F.when(i >= cls.window, code[i - cls.window]).otherwise(F.lit(-1))

            def moved(go: Column) -> Column:
                less = F.when(go >= 0, table_[acc.n[F.greatest(go, F.lit(0))] - 1]
                              - table_[acc.n[F.greatest(go, F.lit(0))]]).otherwise(F.lit(0))
                # the count that the new character meets, after the old one has left
                met = acc.n[came] - F.when(go == came, 1).otherwise(0)
                total = acc.sum + less + table_[met + 1] - table_[met]
                counts = F.transform(acc.n, lambda c, k: c + F.when(k == came, 1).otherwise(0)
                                     - F.when(k == go, 1).otherwise(0))
                return F.struct(
                    counts.alias("n"), total.cast("long").alias("sum"),
                    (acc.hit | ((i >= cls.window - 1) & (total <= most))).alias("hit"))

            return bind(gone, moved)

        return F.aggregate(F.sequence(F.lit(0), F.size(code) - 1), start, step, lambda a: a.hit)

    return bind(codes, lambda c: F.when(F.size(c) < cls.window, F.lit(False)).otherwise(
        bind(f, lambda t: over(c, t))))


def _covers(hits: Column, h: Column) -> Column:
    """Whether one of ``hits`` covers ``h``. They are in order and do not overlap, so the last
    one that starts no later decides; it is found by bisection."""
    def halve(acc: Column, _: Column) -> Column:
        return bind(F.floor((acc.low + acc.high) / 2).cast("int"), lambda mid: bind(
            F.get(hits, mid).start <= h.start, lambda left: F.when(
                acc.low >= acc.high, acc).otherwise(F.struct(
                    F.when(left, mid + 1).otherwise(acc.low).alias("low"),
                    F.when(left, acc.high).otherwise(mid).alias("high")))))

    rounds = F.sequence(F.lit(1), F.length(F.bin(F.size(hits))))
    last = F.aggregate(rounds, F.struct(F.lit(0).alias("low"), F.size(hits).alias("high")), halve,
                       lambda a: F.get(hits, a.low - 1).end)
    return F.when(F.size(hits) == 0, F.lit(False)).otherwise(F.coalesce(last >= h.end, F.lit(False)))


def _spans(hits: Column, kind: str, rank: int) -> Column:
    return F.transform(hits, lambda h: F.struct(
        h.start.alias("start"), F.lit(rank).alias("rank"), h.end.alias("end"),
        F.lit(kind).alias("kind")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def scan_secrets(docs: DataFrame, classes: tuple[EntropyClass, ...] = CLASSES,
                 allow: tuple[str, ...] = ALLOW, slug_part: str | None = SLUG_PART,
                 text_col: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` plus ``out``: struct of ``base`` and ``all`` spans, each an array of
    (start, rank, end, kind) by start and then kind.

    Base spans: an assignment of 12 or more value characters to a key word, an
    access key id, a run of lower-case hex digits. The method adds candidate
    runs of a character class in which some window reaches the class's entropy,
    unless an allow-list pattern matches, all parts between separators match ``slug_part``
    (None: no such test), or another span already covers them.

    Nulls: a null text counts as empty and has no spans; other columns are not
    read. Empty tables stay empty, repeated rows are scanned one by one, a
    column named ``out`` is replaced. Work is linear in the text; m matches of a
    pattern within one document cost another m * sqrt(m) steps.
    """
    t = F.coalesce(F.col(text_col), F.lit(""))
    low = F.lower(t)
    worded = (low.contains("passw") | low.contains("secret") | low.contains("token")
              | low.contains("api"))
    assign = F.filter(_only_if(worded, _located(t, ASSIGN)), lambda h: F.length(
        F.regexp_replace(h.found, "^" + ASSIGN_HEAD, "")) >= MIN_ASSIGN)
    access = _only_if(t.contains("AKIA"), _located(t, ACCESS))
    hexes = _located(t, HEX)
    base_col = free_name(docs, "__base")
    # the generators keep Spark from repeating what they hold wherever it is used
    hits_col = free_name(docs, "__hits")
    located = docs.select("*", F.explode(F.array(F.struct(
        assign.alias("assign"), access.alias("access"), hexes.alias("hex"),
        t.alias("text")))).alias(hits_col))
    hits = [F.col(f"{hits_col}.{kind}") for kind in KINDS]
    text = F.col(f"{hits_col}.text")
    based = located.select("*", F.explode(F.array(F.array_sort(F.concat(
        *[_spans(h, kind, i) for i, (h, kind) in enumerate(zip(hits, KINDS))])))).alias(base_col))
    spans = F.col(base_col)

    def added(cls: EntropyClass, rank: int) -> Column:
        def wanted(h: Column) -> Column:
            allowed = F.lit(False)
            for pattern in allow:
                allowed = allowed | h.found.rlike(pattern)
            if slug_part is not None:
                allowed = allowed | _is_slug(h.found, slug_part)
            for own in hits:
                allowed = allowed | _covers(own, h)
            return F.when(allowed, F.lit(False)).otherwise(
                _max_entropy_reached(h.found, cls))

        return _spans(F.filter(_located(text, cls.pattern), wanted), cls.kind, rank)

    extra = [added(c, len(KINDS) + i) for i, c in enumerate(classes)]
    more = free_name(docs, "__more")
    full = based.select("*", F.explode(F.array(F.concat(*extra) if extra else F.array().cast(
        "array<struct<start:int,rank:int,end:int,kind:string>>"))).alias(more))
    return full.withColumn(out, F.struct(
        spans.alias("base"), F.array_sort(F.concat(spans, F.col(more))).alias("all"),
    )).drop(hits_col, base_col, more)


def without_secrets(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span's text replaced by ``mask``; overlapping spans become one.

    Documents without spans keep their text as it is (null stays null).
    """
    found = free_name(docs, "__secrets")
    scanned = scan_secrets(docs, text_col=text_col, out=found)
    spans, text = F.col(f"{found}.all"), F.col(text_col)

    def cut(block: Column, _: Column) -> Column:
        # a block's text is taken out first: finding a place in a text costs its distance
        low = block[0].low
        own = text.substr(low + 1, F.element_at(block, -1).high - low)
        return bind(own, lambda o: F.array_join(F.transform(block, lambda g: F.concat(
            F.substr(o, g.low - low + 1, g.high - g.low), F.lit(mask))), ""))

    def written(ends: Column) -> Column:
        # the gaps between the masks; a span that starts before an earlier one's end has none
        gaps = F.filter(F.transform(spans, lambda s, i: F.struct(
            F.when(i > 0, F.get(ends, i - 1)).otherwise(F.lit(0)).alias("low"),
            s.start.alias("high"))), lambda g: g.high >= g.low)
        tail = text.substr(F.element_at(ends, -1) + 1, F.length(text))
        return F.concat(bind(gaps, lambda g: F.array_join(_blocks(g, cut), "")), tail)

    masked = bind(_running(F.transform(spans, lambda s: s.end), lambda a, x: F.greatest(a, x)), written)
    return scanned.withColumn(text_col, F.when(F.size(spans) > 0, masked).otherwise(text)).drop(found)


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets.base", lambda s: s.kind == kind)).cast("long")

    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.col("secrets.base")), 256).alias("base_sha256"),
        _joined(F.col("secrets.all")).alias("spans"))
