"""Line dedup by winnowing: later copies of long passages are cut out of the texts.

Copied passages seldom keep the newlines of their source and often start in mid-line, so a line
is ``line`` consecutive words wherever it starts (words are runs of non-white-space: space and
U+0009 to U+000D separate).  Lines are hashed, and of every ``window`` consecutive line hashes
the smallest (of equal ones see ``selected``) is a fingerprint with its position.  Two texts
that share line + window - 1 words therefore share a selected line: with 26 and 25, any run of
50 words.

The first selected occurrence of a line in (id, text hash, position) order is its original.
Every later one is matched with it (within one document only if it starts at least
``min_words`` later, so a repeat never deletes its own original); matches on the same diagonal
whose lines touch or overlap form one run; a run is extended both ways word by word, by at most
line + window - 1 words, beyond which a further match carries on; runs of at least ``min_words``
words are deleted.  Comparison is by the words themselves at the ends and by 64-bit hashes of the
lines in between.

A second pass makes this exact, as a passage's lines may have their originals in other places than
the passage: a window of ``min_words`` words that lies in no deleted run, but whose smallest line
has an earlier occurrence, is compared by its own 64-bit hash with the first window of that hash,
and deleted if that is in an earlier document or ends before it in the same one.  So a word goes
if, and only if, some window of ``min_words`` words around it occurred before; the one exception
is text that repeats itself with a period below ``window`` words, where a line that first occurs
fewer than ``min_words`` words before in the same document is not matched.  A window in a deleted
run is never a first occurrence, hence only windows at the edges of runs and around matches that
stayed too short are asked, and only those and the places around originals are searched.

Skew: originals are minima per line hash (pre-aggregated), matches carry positions only, and
contexts are fetched once per distinct position of an original, however many copies refer to it.

Defined cases: a null text stays null and an empty or short one as it is; rows are told apart by
id and text, so repeated rows (same id, same text) are one document and stay alike; rows without
an id come last in the order and may be cleaned too; ties in the order are equal rows; an empty
table gives no rows; other columns are passed through, whatever their names (one called as
``spans_col`` is replaced).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import cut, fits_broadcast, free_names, text_or_empty

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BYTE_VALUE = np.arange(1, 257, dtype=np.uint64)
#: So many positions of originals (some 30 bytes each) may be broadcast.
BROADCAST_ROWS = 400_000
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as far as they were needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.empty(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 12)
            self.up, self.down = (np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, b, np.uint64))))
                                  for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where words start and end."""
    space = np.ones(len(data) + 2, np.int8)
    space[1:-1] = SPACE[np.frombuffer(data, np.uint8)]
    change = np.flatnonzero(space[1:] != space[:-1])
    return change[::2], change[1::2]


def spread(values: np.ndarray, powers: Powers) -> np.ndarray:
    """Prefix sums of values times powers; differences of them are polynomial hashes."""
    up, _ = powers.upto(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up, out=out[1:])
    return out


def line_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray, line: int, of_bytes: Powers, of_words: Powers) -> np.ndarray:
    """A 64-bit hash for every line of so many words."""
    sums = spread(BYTE_VALUE[np.frombuffer(data, np.uint8)], of_bytes)
    words = mixed((sums[ends] - sums[starts]) * of_bytes.upto(len(data))[1][starts] + (ends - starts).astype(np.uint64))
    sums = spread(words, of_words)
    n = len(words) - line + 1
    return mixed((sums[line:] - sums[:n]) * of_words.upto(len(words))[1][:n])


def sliding(pick, values: np.ndarray, window: int) -> np.ndarray:
    """The smallest or largest of every window of values, from windows of 1, 2, 4, ... values."""
    width = 1
    while 2 * width <= window:
        values = pick(values[:-width], values[width:])
        width *= 2
    rest = window - width
    return pick(values[:len(values) - rest], values[rest:]) if rest else values


def selected(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the winnowed line hashes; none if there are fewer lines than a window has.

    Of equal smallest hashes the one selected last stays as long as a window holds it, then the
    last of the window is taken, so a repeated line is selected once a window, not at every word.
    """
    if len(hashes) < window:
        return np.empty(0, np.int64)
    least = sliding(np.minimum, hashes, window)
    # a hash is the smallest of a window if the largest of its windows' minima is the hash itself
    edge = np.zeros(window - 1, np.uint64)
    out = np.flatnonzero(sliding(np.maximum, np.concatenate((edge, least, edge)), window) == hashes)
    if not ((hashes[out[1:]] == hashes[out[:-1]]) & (np.diff(out) < window)).any():
        return out
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)
    last = np.empty(len(views), np.int64)
    for at in range(0, len(views), 1 << 14):
        part = views[at:at + (1 << 14)]
        last[at:at + len(part)] = np.arange(at, at + len(part)) + window - 1 - part[:, ::-1].argmin(axis=1)
    changes = (np.flatnonzero(least[1:] != least[:-1]) + 1).tolist() + [len(views)]
    out, at, turn = [], 0, 0
    while at < len(views):
        out.append(int(last[at]))
        while changes[turn] <= at:
            turn += 1
        at = min(changes[turn], out[-1] + 1)
    return np.unique(out)


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc (id, or the largest long without one), key (hash of the text) and the text's bytes."""
    text = text_or_empty(F.col(text_col))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)).alias("doc"),
                       F.xxhash64(text).alias("key"), text.cast("binary").alias("bytes"))


def fingerprints(named: DataFrame, line: int, window: int) -> DataFrame:
    """(hash, doc, key, pos) of every selected line."""

    def run(batches):
        of_bytes, of_words = Powers(BYTE_BASE), Powers(WORD_BASE)
        for b in batches:
            hashes, rows, places = [], [], []
            for row, data in enumerate(b.column("bytes")):
                data = data.as_py()
                starts, ends = words_of(data)
                if len(starts) < line + window - 1:
                    continue
                found = line_hashes(data, starts, ends, line, of_bytes, of_words)
                at = selected(found, window)
                hashes.append(found[at].view(np.int64))
                places.append(at)
                rows.append(np.full(len(at), row))
            if rows:
                rows = np.concatenate(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(hashes)), b.column("doc").take(pa.array(rows)),
                     b.column("key").take(pa.array(rows)), pa.array(np.concatenate(places).astype(np.int32))],
                    ["hash", "doc", "key", "pos"])

    return named.mapInArrow(run, "hash long, doc long, key long, pos int")


def originals(prints: DataFrame) -> DataFrame:
    """(hash, src, src_key, src_pos): the first occurrence of every line that has several."""
    # written before its joins, so that a frequent line's copies can be split over several tasks
    return cut(prints.groupBy("hash").agg(F.min(F.struct("doc", "key", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
               .filter("n > 1").select("hash", F.col("first.doc").alias("src"), F.col("first.key").alias("src_key"),
                                       F.col("first.pos").alias("src_pos")))


def runs(prints: DataFrame, firsts: DataFrame, line: int, window: int, min_words: int) -> DataFrame:
    """Matched runs (doc, key, start, stop, src, src_key, src_start, src_stop) in words, before extension.

    near tells runs that overlap their own original and so delete nothing; loose are the positions
    of the run's lines around which a window of min_words words can leave it (all, if it is near).
    """
    same = (F.col("doc") == F.col("src")) & (F.col("key") == F.col("src_key"))
    matches = (prints.join(firsts, "hash").withColumn("shift", F.col("pos") - F.col("src_pos"))
               .filter(~same | (F.col("shift") != 0)).withColumn("near", same & (F.col("shift") < min_words)))
    diagonal = ["doc", "key", "src", "src_key", "shift", "near"]
    order = Window.partitionBy(*diagonal).orderBy("pos")
    fresh = F.coalesce(F.col("pos") > F.lag("pos").over(order) + line, F.lit(True))
    loose = F.filter("places", lambda p: F.col("near") | (p - window + 1 < F.col("start")) | (p + min_words > F.col("stop")))
    return (matches.withColumn("fresh", fresh.cast("int"))
            .withColumn("run", F.sum("fresh").over(order))
            .groupBy(*diagonal, "run").agg(F.min("pos").alias("start"), (F.max("pos") + line).alias("stop"),
                                           F.collect_list("pos").alias("places"))
            .select("doc", "key", "start", "stop", "src", "src_key", "near", loose.alias("loose"),
                    (F.col("start") - F.col("shift")).alias("src_start"), (F.col("stop") - F.col("shift")).alias("src_stop")))


def contexts(named: DataFrame, found: DataFrame, reach: int) -> DataFrame:
    """(src, src_key, side, at, words): up to reach words before (side 0) or from (side 1) a word."""
    wanted = cut(found.select("src", "src_key", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("src_start").alias("at")),
        F.struct(F.lit(1).alias("side"), F.col("src_stop").alias("at")))).alias("q")).distinct())
    asked = wanted.groupBy(F.col("src").alias("doc"), F.col("src_key").alias("key")).agg(F.collect_list("q").alias("asked"))
    if fits_broadcast(wanted, BROADCAST_ROWS):  # else the texts are shuffled to their questions
        asked = F.broadcast(asked)

    def run(batches):
        for b in batches:
            out = {"src": [], "src_key": [], "side": [], "at": [], "words": []}
            done = set()
            for doc, key, data, qs in zip(*(b.column(c) for c in ("doc", "key", "bytes", "asked"))):
                name, data = (doc.as_py(), key.as_py()), data.as_py()
                if name in done:
                    continue
                done.add(name)
                starts, ends = words_of(data)
                for q in qs.as_py():
                    lo, hi = (max(0, q["at"] - reach), q["at"]) if q["side"] == 0 else (q["at"], min(len(starts), q["at"] + reach))
                    for column, value in zip(out, (*name, q["side"], q["at"], data[starts[lo]:ends[hi - 1]] if lo < hi else b"")):
                        out[column].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(
                out.values(), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))], list(out))

    return named.join(asked, ["doc", "key"]).mapInArrow(
        run, "src long, src_key long, side int, at int, words binary").dropDuplicates(["src", "src_key", "side", "at"])


def repeats(named: DataFrame, found: DataFrame, line: int, window: int) -> DataFrame:
    """(doc, key, about): the matched runs of each document with the words around their originals."""
    around = cut(contexts(named, found, line + window - 1))
    sides = [around.filter(F.col("side") == s).select("src", "src_key", F.col("at").alias(at), F.col("words").alias(name))
             for s, at, name in ((0, "src_start", "left"), (1, "src_stop", "right"))]
    return (found.join(sides[0], ["src", "src_key", "src_start"]).join(sides[1], ["src", "src_key", "src_stop"])
            .groupBy("doc", "key").agg(F.collect_set(F.struct("start", "stop", "left", "right", "loose")).alias("about")))


def windows(texts: DataFrame, line: int, window: int, min_words: int, places) -> DataFrame:
    """(doc, key, runs, wholes, at, hashes) of texts (doc, key, bytes, about).

    places(about, data, starts, ends) gives positions of lines, and runs (start, stop).  wholes and
    at are hashes and positions of the windows of min_words words that lie in no run and have one
    of these lines as their smallest; hashes are those of the lines.
    """
    lists = {"runs": pa.list_(pa.int32()), "wholes": pa.list_(pa.int64()), "at": pa.list_(pa.int32()), "hashes": pa.list_(pa.int64())}

    def run(batches):
        of_bytes, of_words = Powers(BYTE_BASE), Powers(WORD_BASE)
        for b in batches:
            out = {name: [] for name in lists}
            for data, about in zip(b.column("bytes"), b.column("about")):
                data = data.as_py()
                starts, ends = words_of(data)
                at, inner = places(about.as_py(), data, starts, ends)
                lines = line_hashes(data, starts, ends, line, of_bytes, of_words)
                least = sliding(np.minimum, lines, window)[:max(0, len(starts) - min_words + 1)]
                take = np.zeros(len(least), bool)
                for p in at:
                    lo = max(0, p - window + 1)
                    take[lo:p + 1] |= least[lo:p + 1] == lines[p]
                for start, stop in inner:
                    take[start:stop - min_words + 1] = False
                take = np.flatnonzero(take)
                wholes = line_hashes(data, starts, ends, min_words, of_bytes, of_words)[take] if len(take) else least[take]
                out["runs"].append([end for r in inner for end in r])
                out["wholes"].append(wholes.view(np.int64))
                out["at"].append(take.astype(np.int32))
                out["hashes"].append(np.unique(least[take]).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("key")] + [pa.array(out[n], t) for n, t in lists.items()],
                                             ["doc", "key", *lists])

    return texts.mapInArrow(run, "doc long, key long, runs array<int>, wholes array<long>, at array<int>, hashes array<long>") \
        .dropDuplicates(["doc", "key"])


def _some(named: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of wanted (doc, key), if these are few, so that only they are shuffled; else all."""
    keys = wanted.select("doc", "key")
    return named.join(F.broadcast(keys), ["doc", "key"], "left_semi") if fits_broadcast(keys, BROADCAST_ROWS) else named


def deletions(named: DataFrame, line: int, window: int, min_words: int) -> DataFrame:
    """(doc, key, runs, more): starts and stops of the deleted runs, and where further deleted windows start."""
    prints = cut(fingerprints(named, line, window))
    firsts = originals(prints)
    found = cut(runs(prints, firsts, line, window, min_words))
    about = cut(repeats(named, found.filter("NOT near"), line, window))

    def edges(found, data, starts, ends):
        return [p for r in found for p in r["loose"]], deleted_runs(data, starts, ends, found, min_words)

    seen = cut(windows(_some(named, about).join(about, ["doc", "key"]), line, window, min_words, edges))

    def flat(df):
        return df.select("doc", "key", F.explode(F.arrays_zip("wholes", "at")).alias("w")).select(
            "doc", "key", F.col("w.wholes").alias("whole"), F.col("w.at").alias("pos"))

    # a window's first occurrence is asked itself, or lies around its line's original or a near line
    asked = flat(seen)
    lines = cut(seen.select(F.explode("hashes").alias("hash")).distinct())
    places = (firsts.join(lines, "hash").select(F.col("src").alias("doc"), F.col("src_key").alias("key"), F.col("src_pos").alias("pos"))
              .unionByName(found.filter("near").select("doc", "key", F.explode("loose").alias("pos"))))
    there = cut(places.groupBy("doc", "key").agg(F.collect_set("pos").alias("about")))
    answers = flat(windows(_some(named, there).join(there, ["doc", "key"]), line, window, min_words, lambda at, *_: (at, [])))
    least = cut(asked.unionByName(answers).groupBy("whole").agg(F.min(F.struct("doc", "key", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
                .filter("n > 1").select("whole", F.col("first.doc").alias("src"), F.col("first.key").alias("src_key"),
                                        F.col("first.pos").alias("src_pos")))
    if fits_broadcast(least, BROADCAST_ROWS):
        least = F.broadcast(least)
    same = (F.col("doc") == F.col("src")) & (F.col("key") == F.col("src_key"))
    more = (asked.join(least, "whole").filter(~same | (F.col("pos") - F.col("src_pos") >= min_words))
            .groupBy("doc", "key").agg(F.collect_set("pos").alias("more")))
    return seen.select("doc", "key", "runs").join(more, ["doc", "key"], "left").filter("size(runs) > 0 OR more IS NOT NULL")


def extended(words: list[bytes], start: int, stop: int, left: list[bytes], right: list[bytes]) -> tuple[int, int]:
    """A run of words grown as far as the words around its original agree."""
    while start > 0 and left and words[start - 1] == left[-1]:
        start -= 1
        left = left[:-1]
    for word in right:
        if stop >= len(words) or words[stop] != word:
            break
        stop += 1
    return start, stop


def deleted_runs(data: bytes, starts: np.ndarray, ends: np.ndarray, found: list[dict], min_words: int) -> list[tuple[int, int]]:
    """The matched runs of a text, extended, that are long enough."""
    words = [data[s:e] for s, e in zip(starts.tolist(), ends.tolist())]
    grown = [extended(words, r["start"], r["stop"], r["left"].split(), r["right"].split()) for r in found]
    return [(a, z) for a, z in grown if z - a >= min_words]


def cut_out(data: bytes, found: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]], int]:
    """The text without these runs of words, their byte spans in the old text, and the words removed."""
    starts, ends = words_of(data)
    gone = np.zeros(len(starts) + 1, bool)
    for a, z in found:
        gone[a:z] = True
    edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0))
    spans, kept, at = [], [], 0
    for a, z in zip(edges[::2].tolist(), edges[1::2].tolist()):
        spans.append((int(starts[a]), int(ends[z - 1])))
        kept.append(data[at:spans[-1][0]])
        at = int(starts[z]) if z < len(starts) else len(data)
    kept.append(data[at:])
    return b"".join(kept), spans, int(gone.sum())


def dedup(docs: DataFrame, id_col: str, text_col: str, line: int = 26, window: int = 25, min_words: int = 50,
          spans_col: str | None = None) -> DataFrame:
    """docs with later repeated runs cut out of text_col.

    With spans_col, a string column of that name is added: start:end of every deleted run in code
    points of the old text, comma-joined (empty if nothing went).
    """
    if line > min_words or line + window - 1 > min_words or window > line:
        raise ValueError("a run of min_words words must hold a window of lines, and lines must touch")
    found = deletions(_named(docs, id_col, text_col), line, window, min_words)
    docs = docs.drop(spans_col) if spans_col else docs
    columns = docs.columns
    schema = StructType([StructField(f.name, StringType()) if f.name == text_col else f for f in docs.schema.fields]
                        + ([StructField(spans_col, StringType())] if spans_col else []))
    place = columns.index(text_col)

    def run(batches):
        for b in batches:
            arrays = list(b.columns[:-2])
            texts, marks = arrays[place].to_pylist(), []
            for row, (found_here, more) in enumerate(zip(*b.columns[-2:])):
                spans = []
                if found_here.is_valid:
                    data = texts[row].encode()
                    ends = found_here.as_py()
                    new, cuts, _ = cut_out(data, [*zip(ends[::2], ends[1::2]), *((p, p + min_words) for p in more.as_py() or [])])
                    spans = [(len(data[:a].decode()), len(data[:z].decode())) for a, z in cuts]
                    texts[row] = new.decode()
                marks.append(",".join(f"{a}:{z}" for a, z in spans))
            arrays[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays + ([pa.array(marks, pa.string())] if spans_col else []),
                                             [f.name for f in schema.fields])

    # the original columns travel under names that are free
    doc, key, runs_, more_ = free_names(docs, "doc", "key", "runs", "more")
    text = F.col(f"`{text_col}`")
    rows = docs.withColumn(text_col, text.cast("string")).withColumns(
        {doc: F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(2**63 - 1)), key: F.xxhash64(text_or_empty(text))})
    found = cut(found.select(F.col("doc").alias(doc), F.col("key").alias(key), F.col("runs").alias(runs_), F.col("more").alias(more_)))
    here = [F.col(f"`{c}`") for c in columns]
    keys = found.select(doc, key)
    if not fits_broadcast(keys, BROADCAST_ROWS):
        return rows.join(found, [doc, key], "left").select(*here, runs_, more_).mapInArrow(run, schema)
    # few texts change: only these are shuffled and go through Python
    same = rows.join(F.broadcast(keys), [doc, key], "left_anti").select(*here, *([F.lit("").alias(spans_col)] if spans_col else []))
    changed = (rows.join(F.broadcast(keys), [doc, key], "left_semi").join(found, [doc, key])
               .select(*here, runs_, more_).mapInArrow(run, schema))
    return same.union(changed)
