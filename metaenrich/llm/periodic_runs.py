"""Periodic runs of words, found as Kolpakov and Kucherov do.

Method: a text's Lempel-Ziv factors come from its suffix automaton: each factor is the longest stretch that also starts
earlier, or one new word. A run that touches a border between factors is found by Main's algorithm, from the longest
common extensions to both sides of that border; its bounds on how far such a run can reach keep all borders together
linear. A run inside a factor is a copy of one inside the factor's earlier occurrence, so it is copied.

Before that, stretches that can't be part of a run are put aside, without loss: in a run of at least MIN_LENGTH words
and MIN_PERIODS periods every word lies in a sequence of SURE words that occurs again within the run. So does each run
as a whole, in one stretch of words covered by such sequences; only these stretches are factorised.

Null text has no words, as a text of white space alone. Repeated rows each give their own row; a null id stays null (and
its text is never rewritten). Other columns are ignored. An empty table gives an empty result. Time is linear in the
words, memory is that of the longest repetitive stretch.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rolling, rows_of

MIN_LENGTH = 24
MIN_PERIODS = 3


def sure_repeat(min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> int:
    """Words that two places of a run, one period apart, have in common at least."""
    return min(max(min_length - q, (min_periods - 1) * q) for q in range(1, min_length + 1))


def factors(s: list[int]) -> list[tuple[int, int, int]]:
    """Lempel-Ziv factors (start, length, start of an earlier occurrence or -1); the occurrence may overlap the factor."""
    # Most states have one transition: it stands in two lists. Further ones of a state stand in a dictionary of its own.
    symbol, target, more = [-1], [0], {}
    link, length, end = [-1], [0], [-1]  # end: the first place where the state's words end
    last = 0
    for i, c in enumerate(s):
        new = len(length)
        length.append(i + 1)
        end.append(i)
        link.append(0)
        symbol.append(-1)
        target.append(0)
        p, q = last, -1
        while p >= 0:
            if symbol[p] == c:
                q = target[p]
                break
            if symbol[p] < 0:
                symbol[p], target[p] = c, new
            elif p not in more:
                more[p] = {c: new}
            elif c in more[p]:
                q = more[p][c]
                break
            else:
                more[p][c] = new
            p = link[p]
        if q >= 0 and length[p] + 1 == length[q]:
            link[new] = q
        elif q >= 0:
            clone = len(length)
            length.append(length[p] + 1)
            end.append(end[q])
            link.append(link[q])
            symbol.append(symbol[q])
            target.append(target[q])
            if q in more:
                more[clone] = dict(more[q])
            while p >= 0:
                if symbol[p] == c and target[p] == q:
                    target[p] = clone
                elif p in more and more[p].get(c) == q:
                    more[p][c] = clone
                else:
                    break
                p = link[p]
            link[q] = link[new] = clone
        last = new
    out, start, n = [], 0, len(s)
    while start < n:
        state, at, source = 0, start, -1
        while at < n:
            c = s[at]
            state = target[state] if symbol[state] == c else more[state][c]
            if end[state] >= at:  # this stretch ends here for the first time
                break
            source = end[state] - (at - start)
            at += 1
        out.append((start, max(1, at - start), source))
        start = max(at, start + 1)
    return out


def _common_prefixes(s: list[int]) -> list[int]:
    """For each place: how far the sequence from there on equals its beginning."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        left, right = i, i + k
    return z


def _touching(s: list[int], border: int, before: int, after: int, min_length: int, min_periods: int) -> Iterator[tuple[int, int, int]]:
    """Main's algorithm: runs (start, end, period) that reach or touch the border between two factors of these lengths.

    Of a run that later borders touch too, none is given unless it ends with the second factor: they find it. As the
    first factor is longest, no run of period q that goes on behind the border starts more than q words before that
    factor; with its min_periods periods that bounds q, and how much of the left side can matter.
    """
    most = (before + after - 1) // (min_periods - 1)
    if before + most + after < min_length:
        return
    low = max(0, border - before - most)
    left, right = s[low:border], s[border : border + after]
    back = left[::-1]
    n_left, n_right = len(left), len(right)
    ahead = np.array(_common_prefixes(right) + [0], np.int64)
    ahead_of_left = np.array(_common_prefixes([*right, -1, *left]), np.int64)
    behind = np.array(_common_prefixes(back) + [0], np.int64)
    behind_right = np.array(_common_prefixes([*back, -1, *right[::-1], *back]), np.int64)
    forward = np.arange(1, min(most, n_right) + 1)  # periods of runs that hold a whole period behind the border
    backward = np.arange(1, min(most, n_left) + 1)  # and before it
    # Where the left side's end equals the whole right side's beginning up to the border, the match goes on into the right side.
    on = ahead_of_left[n_right + 1 + n_left - backward]
    on = np.where(on == backward, backward + ahead[np.minimum(backward, n_right)], on)
    on = np.minimum(on, n_right)
    shapes = (
        (forward, ahead[forward], behind_right[n_left + 1 + n_right - forward], 0),
        (backward, on, behind[np.minimum(backward, n_left)], 1),
    )
    for periods, reach, tail, shift in shapes:
        length = periods + reach + tail
        for k in np.flatnonzero((length >= min_length) & (length >= min_periods * periods)).tolist():
            q, start = int(periods[k]), border - int(tail[k]) - shift * int(periods[k])
            stop = start + int(length[k])
            if (start == 0 or s[start - 1] != s[start - 1 + q]) and (stop == len(s) or s[stop] != s[stop - q]):
                yield start, stop, q


def stretch_runs(s: list[int], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """The runs (start, length, smallest period) of a sequence of numbers from 0 on, by start, then period."""
    found: dict[tuple[int, int], int] = {}
    ordered: list[tuple[int, int]] = []  # keys of found

    def add(start: int, stop: int, q: int) -> None:
        if (start, stop) not in found:
            found[start, stop] = q
            insort(ordered, (start, stop))
        elif q < found[start, stop]:
            found[start, stop] = q

    before = 0
    for start, length, source in [*factors(s), (len(s), 0, -1)]:  # the end is a border too
        if before:
            for run in _touching(s, start, before, length, min_length, min_periods):
                add(*run)
        if source >= 0:
            # Runs strictly inside the factor are those strictly inside its source. Copies may be copied again.
            k, limit = bisect_right(ordered, (source, len(s))), source + length
            while k < len(ordered) and ordered[k][0] < limit:
                a, b = ordered[k]
                if b < limit:
                    add(a + start - source, b + start - source, found[a, b])
                k += 1
        before = length
    return sorted((a, b - a, q) for (a, b), q in found.items())


def stretches(ids: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Parts (start, end) of the sequence outside of which no word can be in a run: covered by sequences of width words that are there twice."""
    out, work = [], [(0, len(ids))]
    while work:
        low, high = work.pop()
        grams = rolling(ids[low:high], width)
        if len(grams) < 2:
            continue
        order = np.argsort(grams, kind="stable")
        same = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
        if not len(same):
            continue
        edges = np.zeros(high - low + 1, np.int64)
        starts = np.union1d(order[same], order[same + 1])
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + width, -1)
        covered = np.diff(np.concatenate([[0], (np.cumsum(edges[:-1]) > 0).astype(np.int8), [0]]))
        parts = [(low + a, low + b) for a, b in zip(np.flatnonzero(covered == 1).tolist(), np.flatnonzero(covered == -1).tolist(), strict=True)]
        if parts == [(low, high)]:
            out += parts
        else:
            work += parts  # what repeats only outside of a part goes in the next look
    return sorted(out)


def word_runs(words: list[bytes], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """The runs (start, length, smallest period) of a list of words."""
    if len(words) < min_length:
        return []
    known: dict[bytes, int] = {}
    ids = [known.setdefault(w, len(known)) for w in words]
    # Odd multiples spread the numbers over 64 bits, as the rolling hash expects.
    spread = (np.array(ids, np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    return [(a + start, length, q) for a, b in stretches(spread, sure_repeat(min_length, min_periods)) for start, length, q in stretch_runs(ids[a:b], min_length, min_periods)]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        gone[start + q] += 1
        gone[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]


def stretched(words: list[bytes], key: int | None) -> list[bytes]:
    """The words with, for one key in ten, a period planted from some word on; both follow from the key's checksum."""
    n = len(words)
    if key is None or not n:
        return words
    h = zlib.crc32(b"%d" % key)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS, prepare=None) -> DataFrame:
    """A row a document: its id (named as key), its runs (start, length, period), and its collapsed words joined by blanks.

    prepare(words, id), if given, edits the words before; it must give the same for the same row on each try.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                found, kept = [], []
                for doc, data in rows_of([batch], "id", "text"):
                    words = (data or b"").split()  # of bytes: at space, tab, line feed, vertical tab, form feed, carriage return
                    if prepare:
                        words = prepare(words, doc)
                    runs = word_runs(words, min_length, min_periods)
                    found.append([{"start": a, "length": n, "period": q} for a, n, q in runs])
                    kept.append(b" ".join(collapsed(words, runs)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, run_type), pa.array(kept, pa.binary()).cast(pa.string())], ["id", "runs", "collapsed"])

    return rows.mapInArrow(run, f"id {id_type}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string").withColumnRenamed("id", key)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Of find()'s rows: the number of runs, the one of greatest exponent, and hashes of all runs and of the collapsed text."""
    # Exponents are compared exactly: a/b > c/d as a*d > c*b. Runs come by start and period, so the first of equals stays.
    best = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)), lambda m, r: F.when(r["length"] * m["period"] > m["length"] * r["period"], r).otherwise(m)
    )
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        key,
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.expr("1000 * best.length div best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
