"""Personal data by fixed formats, and by bootstrapped contextual extraction.

The fixed formats give seed entities. The words before a seed or any other identifier-like token are its lexical
pattern (the last word, and the last two). Patterns and instances form a bipartite graph: a pattern's confidence in
a kind is the score of its instances over *all* places where its words occur in the corpus, and an unknown
instance's score is that at least one of its patterns is right. Both are computed in turn for some rounds; patterns
of high confidence then label the unseen identifiers that follow them, if these have the kind's rough shape.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genespark.llm.util import Texts, map_text, materialize, pieces

# The kinds, in the order in which equal starts are listed.
KINDS = ("email", "ip", "card", "phone")
_NAME = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a number is never entered in its middle: from there on it fails as from its start
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_TOKEN = re.compile(r"[^\s\"'<>,;]*")
_WORD = re.compile(r"[^\W\d_]+")
_LAST = re.compile(r"[^\W\d_]*\Z")
_NOT_GROUPED = re.compile(r"[^0-9().+/-]")
_GROUPS = re.compile(r"[0-9](?:[ ()./-]{0,3}[0-9])*")
_BLANKS = " \n\t\r\x0b\x0c\"'<>,;"
_TRIM = ".:!?()[]{}=*#&$%"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(t: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping; found from each @ outwards, so a long run without @ costs nothing."""
    out, end, low = [], 0, 0
    at = t.find("@")
    while at >= 0:
        head = t[max(end, low) : at]
        size = len(head) - len(head.rstrip(_NAME))
        if size and (m := _HOST.match(t, at + 1)):
            out.append((at - size, m.end()))
            end = m.end()
        low = at + 1
        at = t.find("@", low)
    return out


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed formats, sorted."""
    out = [(a, 0, b) for a, b in emails(t)]
    if _ANY.search(t):
        for m in _IP.finditer(t):
            if all(len(x := p.lstrip("0")) <= 3 and int(x or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(t):
            if m.end() - m.start() >= 12 and 12 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(t):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def shapes(token: str) -> int:
    """Which kinds an unseen token may be (bits), by rough shape only."""
    digits = sum(c.isascii() and c.isdigit() for c in token)
    others = set(token) - set("0123456789 ().-+/")
    mask = 0
    if 0 < token.find("@") < len(token) - 3:
        mask |= 1
    if re.fullmatch(r"(?:[0-9]{1,4}\.){3,}[0-9]{1,4}|(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}", token):
        mask |= 2
    if 12 <= digits <= 19 and not others:
        mask |= 4
    if 7 <= digits <= 15 and not others:
        mask |= 8
    return mask


def candidates(t: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, shapes) of identifier-like tokens that overlap no fixed format.

    A token lies between blanks, quotes and the like; one of digits and their separators goes on over blanks, as
    numbers written in groups do, up to the next fixed format.
    """
    out, pos, k, passed = [], 0, 0, 0
    while m := _ANY.search(t, pos):
        at = m.start()
        while k < len(base) and base[k][2] <= at:
            passed = max(passed, base[k][2])
            k += 1
        left = max(pos, *(t.rfind(c, pos, at) + 1 for c in _BLANKS))
        right = _TOKEN.match(t, at).end()
        grouped = t[at] != "@" and not _NOT_GROUPED.search(t, left, right)
        if grouped:
            ahead = next((base[j][0] for j in range(k, len(base)) if base[j][0] > at), len(t))
            right = _GROUPS.match(t, at, ahead).end()
        pos = max(right, at + 1)
        token = t[left:right]
        lead = _TRIM.replace("(", "") if grouped and ")" in token else _TRIM
        left += len(token) - len(token.lstrip(lead))
        token = t[left:right].rstrip(_TRIM)
        if not (mask := shapes(token)) or passed > left:
            continue
        j, clear = k, True
        while j < len(base) and base[j][0] < left + len(token):
            clear &= base[j][2] <= left
            j += 1
        if clear:
            out.append((left, left + len(token), mask))
    return out


def contexts(t: str, starts: list[int]) -> list[tuple[str | None, str | None]]:
    """The word before each of the ascending `starts`, and the two words before it, lower-cased; each stretch is read once."""
    out = []
    at, one, two = 0, None, None  # the last words that end before `at`
    for start in starts:
        words = _WORD.findall(t[at:start].lower())
        last = ([w for w in (two, one) if w] + words)[-3:]
        out.append((last[-1] if last else None, " ".join(last[-2:]) if len(last) > 1 else None))
        at = start
        if words and start < len(t) and _WORD.match(t, start - 1) and _WORD.match(t, start):  # the word goes on in what follows
            at, last = start - len(_LAST.search(t[at - len(words[-1]) : start])[0]), last[:-1]
        one, two = (last[-1] if last else None), (last[-2] if len(last) > 1 else None)
    return out


def join_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def extract(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds the fixed formats (b_start, b_kind, b_end) and the slots (s_...): seeds and candidates with their contexts."""

    def make():
        def of(texts: Texts) -> list[pa.Array]:
            cols: list[list] = [[] for _ in range(9)]
            for i in range(texts.n):
                t = texts.bytes(i).decode("utf-8", "replace")
                base = base_spans(t)
                slots = [(a, b, -1, k, hashlib.blake2b(t[a:b].lower().encode(), digest_size=8).digest()) for a, k, b in base]
                slots += [(a, b, mask, -1, hashlib.blake2b(t[a:b].lower().encode(), digest_size=8).digest()) for a, b, mask in candidates(t, base)]
                slots.sort()
                near = contexts(t, [s[0] for s in slots])
                row = ([a for a, _, _ in base], [k for _, k, _ in base], [b for _, _, b in base], [s[0] for s in slots], [s[1] for s in slots], [s[3] if s[2] < 0 else -s[2] for s in slots], [int.from_bytes(s[4], "big", signed=True) for s in slots], [c[0] for c in near], [c[1] for c in near])
                for col, x in zip(cols, row, strict=True):
                    col.append(x)
            kinds = [pa.int32()] * 6 + [pa.int64(), pa.string(), pa.string()]
            return [pa.array(c, pa.list_(k)) for c, k in zip(cols, kinds, strict=True)]

        return of

    fields = [*((n, "array<int>") for n in ("b_start", "b_kind", "b_end", "s_start", "s_end", "s_what")), ("s_id", "array<long>"), ("s_one", "array<string>"), ("s_two", "array<string>")]
    return map_text(docs, text, make, fields, keep=keep)


def count_contexts(docs: DataFrame, patterns: list[str], *, text: str = "text") -> DataFrame:
    """(pattern, total): all places in the corpus where the words of each pattern occur."""
    sent = docs.sparkSession.sparkContext.broadcast((frozenset(p for p in patterns if " " not in p), frozenset(tuple(p.split(" ")) for p in patterns if " " in p)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = sent.value
        seen: Counter = Counter()
        for part in pieces(batches, 0, 1 << 21):
            texts = Texts(part.column(0))
            for i in range(texts.n):
                words = _WORD.findall(texts.bytes(i).decode("utf-8", "replace").lower())
                seen.update(filter(one.__contains__, words))
                seen.update(filter(two.__contains__, zip(words, words[1:], strict=False)))
        if seen:
            names = [k if isinstance(k, str) else " ".join(k) for k in seen]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(list(seen.values()), pa.int64())], ["pattern", "total"])

    return docs.select(F.col(f"`{text}`").cast("string").alias("t")).mapInArrow(count, "pattern string, total long").groupBy("pattern").agg(F.sum("total").alias("total"))


def learn(docs: DataFrame, found: DataFrame, *, text: str = "text", support: int = 3, rounds: int = 3, most_patterns: int = 100_000) -> DataFrame | None:
    """(pattern, kind, confidence) after `rounds` of scoring the graph of patterns and instances; None without patterns.

    A pattern needs `support` distinct instances at every size. Their places are counted in blocks of about
    `most_patterns` patterns, one scan of the texts each, so that what is sent to the executors has a fixed bound.
    """
    slots = found.select(F.inline(F.arrays_zip("s_what", "s_id", "s_one", "s_two")))
    edges = slots.select("s_what", "s_id", F.explode(F.array("s_one", "s_two")).alias("pattern")).where("pattern is not null").groupBy("pattern", "s_id", "s_what").agg(F.count(F.lit(1)).alias("n"))
    edges = materialize(edges, "pii-edges")
    frequent = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances")).where(F.col("instances") >= support)
    frequent = materialize(frequent.select("pattern"), "pii-frequent")
    blocks = -(-frequent.count() // most_patterns)
    if not blocks:
        return None
    totals = None
    for k in range(blocks):
        patterns = [r.pattern for r in frequent.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks).cast("long")) == k).collect()]
        if patterns:
            counted = materialize(count_contexts(docs, patterns, text=text), "pii-totals")
            totals = counted if totals is None else totals.unionByName(counted)
    edges = materialize(edges.join(totals, "pattern"), "pii-live")
    kinds = F.explode(F.array(*(F.lit(k) for k in range(len(KINDS)))))
    fits = (F.col("s_what") == F.col("kind")) | ((F.col("s_what") < 0) & (F.shiftright(-F.col("s_what"), 0).bitwiseAND(F.expr("shiftleft(1, kind)")) != 0))
    graph = materialize(edges.withColumn("kind", kinds).where(fits), "pii-graph")
    score = graph.select("s_id", "s_what", "kind").distinct().withColumn("score", (F.col("s_what") >= 0).cast("double"))
    trust = None
    for k in range(rounds):
        trust = graph.join(score, ["s_id", "s_what", "kind"]).groupBy("pattern", "kind").agg((F.sum(F.col("n") * F.col("score")) / (F.max("total") + 1)).alias("confidence"))
        trust = materialize(trust.withColumn("confidence", F.least("confidence", F.lit(0.999))), "pii-trust")
        if k < rounds - 1:
            doubt = graph.join(trust, ["pattern", "kind"]).groupBy("s_id", "s_what", "kind").agg(F.exp(F.sum(F.log1p(-F.col("confidence")))).alias("doubt"))
            score = doubt.select("s_id", "s_what", "kind", F.when(F.col("s_what") >= 0, 1.0).otherwise(1 - F.col("doubt")).alias("score"))
    return trust


def label(found: DataFrame, trust: DataFrame, least: float) -> DataFrame:
    """(uid, m_start, m_kind, m_end): the candidates of each row of `found` that follow a pattern trusted by `least`.

    Two words count before one, then the kind of the higher confidence.
    """
    slots = found.select("uid", F.inline(F.arrays_zip("s_start", "s_end", "s_what", "s_one", "s_two"))).where("s_what < 0")
    slots = slots.select("uid", "s_start", "s_end", "s_what", F.posexplode(F.array("s_two", "s_one")).alias("rank", "pattern")).where("pattern is not null")
    known = slots.join(trust.where(F.col("confidence") >= least), "pattern").where((-F.col("s_what")).bitwiseAND(F.expr("shiftleft(1, kind)")) != 0)
    best = known.groupBy("uid", "s_start", "s_end").agg(F.min(F.struct("rank", (-F.col("confidence")).alias("c"), "kind"))["kind"].alias("kind"))
    return best.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("s_start", "kind", "s_end"))).alias("m")).select("uid", F.col("m.s_start").alias("m_start"), F.col("m.kind").alias("m_kind"), F.col("m.s_end").alias("m_end"))


def find_pii(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, least: float = 0.5, **options) -> DataFrame:
    """Adds n_email, n_ip, n_card, n_phone (fixed formats), base and spans (kind:start:end, comma-joined).

    spans holds the fixed formats and what the learned patterns discover. Offsets are code points, ends
    exclusive. Null texts are empty; an empty table gives an empty result; repeated rows get the same result.
    Texts are scanned whole, however long: memory is a few times that of the longest one.
    """
    keep = [c for c in (docs.columns if keep is None else keep)]
    found = materialize(extract(docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)), F.col(f"`{text}`").alias("t_")), text="t_", keep=[f"c{i}" for i in range(len(keep))]).withColumn("uid", F.monotonically_increasing_id()), "pii")
    trust = learn(docs, found, text=text, **options)
    rows = found.select(*(f"c{i}" for i in range(len(keep))), "uid", "b_start", "b_kind", "b_end")
    none = F.array().cast("array<int>")
    rows = rows.join(label(found, trust, least), "uid", "left") if trust is not None else rows.withColumns({c: none for c in ("m_start", "m_kind", "m_end")})
    rows = rows.select(*(f"c{i}" for i in range(len(keep))), "b_start", "b_kind", "b_end", *(F.coalesce(c, none).alias(c) for c in ("m_start", "m_kind", "m_end")))
    n = len(keep)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, base_text, all_text = [[] for _ in KINDS], [], []
            lists = [c.to_pylist() for c in batch.columns[n:]]
            for b_start, b_kind, b_end, m_start, m_kind, m_end in zip(*lists, strict=True):
                base = list(zip(b_start, b_kind, b_end, strict=True))
                more = list(zip(m_start, m_kind, m_end, strict=True))
                for k, col in enumerate(counts):
                    col.append(b_kind.count(k))
                base_text.append(join_spans(base))
                all_text.append(join_spans(sorted(base + more)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *(pa.array(c, pa.int64()) for c in counts), pa.array(base_text, pa.string()), pa.array(all_text, pa.string())], [f"c{i}" for i in range(n)] + [*(f"n_{k}" for k in KINDS), "base", "spans"])

    schema = ", ".join([*(f"c{i} {found.schema[f'c{i}'].dataType.simpleString()}" for i in range(n)), *(f"n_{k} long" for k in KINDS), "base string, spans string"])
    out = rows.mapInArrow(finish, schema)
    new = [*(f"n_{k}" for k in KINDS), "base", "spans"]
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(keep) if c not in new), *new)
