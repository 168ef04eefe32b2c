"""Grouping of spelling variants by deletion keys.

1. Words are counted where texts are read; counts meet by a shuffle on the word.
2. Words are numbered in code-point order. For each word, prefix and suffix polynomial hashes give the hash of the word
   without each of its code points at once, in NumPy; the word's own hash is one key more.
3. Rows (key, place, number) are dealt out by the keys' upper bits and sorted; keys of one word alone go.
4. What is left meets its strings again and is grouped by the strings without the code point, so that hashes that collide
   tell apart. In a group, words that lack the same place differ by a replacement, and the word that is the group's string
   differs from all others by an insertion. Each near pair meets in one group alone, so near words are counted, and the
   most frequent one is found, without making pairs.
5. Forms are followed to their roots by doubling: counts at least double at each step, so rounds are few.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, entering, numbered, runs_of, small, small_batches, stored, texts_of

#: Shortest words in code points, least occurrences, and a form's least count as a multiple of the word's.
SHORTEST, LEAST, TIMES = 5, 3, 2
#: One of so many words of documents loses a code point.
EDITED = 97
#: About how many keys a task sorts at once.
KEYS = 400_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MOST = 64

_POLY = 0xEDB88320


def _combine_tables() -> np.ndarray:
    """[n, k, v]: the CRC-32 of v in its byte k after n more zero bytes, n up to _MOST."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(_POLY), step >> 1)
    bit = np.uint32(1) << np.arange(32, dtype=np.uint32)
    out, values = np.zeros((_MOST + 1, 4, 256), np.uint32), np.arange(256)
    for n in range(_MOST + 1):
        for k in range(4):
            for j in range(8):
                out[n, k] ^= np.where(values >> j & 1, bit[8 * k + j], np.uint32(0))
        bit = (bit >> np.uint32(8)) ^ step[bit & np.uint32(255)]
    return out


_COMBINE = _combine_tables()


def crc_of(heads: np.ndarray, head: np.ndarray, words: list[bytes], word: np.ndarray) -> np.ndarray:
    """CRC-32 of heads[head] followed by words[word], heads being CRCs: that of a whole is put together from those of its parts."""
    own = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))[word]
    length = np.fromiter(map(len, words), np.int64, len(words))[word]
    h, n = heads[head], np.minimum(length, _MOST)
    out = own ^ _COMBINE[n, 0, h & 255] ^ _COMBINE[n, 1, h >> 8 & 255] ^ _COMBINE[n, 2, h >> 16 & 255] ^ _COMBINE[n, 3, h >> 24]
    for k in np.flatnonzero(length > _MOST).tolist():
        out[k] = zlib.crc32(words[word[k]], int(h[k]))
    return out


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes of A-Z, a-z and U+00C0 to U+00FF, which are those that 0xC3 leads."""
    low = data | 32
    inside = ((low >= 0x61) & (low <= 0x7A) & (data < 0x80)) | (data == 0xC3)
    inside[1:] |= data[:-1] == 0xC3
    return inside


def counts(docs: DataFrame, edited: int | None = EDITED, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """word, n of all words with at least `shortest` code points and `least` occurrences.

    edited: runs whose CRC-32 of `<doc_id>:<run>` it divides lose the code point that the CRC names; a null doc_id is
    nothing before the colon. Null texts have no words.
    """

    def count(batches):
        entering("variants")
        for batch in batches:
            for at, part in texts_of(batch.column(1)):
                words, n = runs_of(part, _letters)
                if not len(words):
                    continue
                coded = words.dictionary_encode()
                names, size = coded.dictionary, len(coded.dictionary)
                doc = np.repeat(np.arange(len(n)), n)
                pair, times = np.unique(doc * size + coded.indices.to_numpy(), return_counts=True)
                doc, word = np.divmod(pair, size)
                new: dict[str, int] = {}
                if edited:
                    heads = [zlib.crc32(b"%s:" % ("" if i is None else str(i)).encode()) for i in batch.column(0).slice(at, len(part)).to_pylist()]
                    h = crc_of(np.array(heads, np.uint32), doc, names.cast(pa.large_binary()).to_pylist(), word)
                    gone = np.flatnonzero(h % edited == 0)
                    for w, c, m in zip(names.take(pa.array(word[gone])).to_pylist(), h[gone].tolist(), times[gone].tolist()):
                        k = c % len(w)
                        if len(w) > shortest:
                            new[w[:k] + w[k + 1 :]] = new.get(w[:k] + w[k + 1 :], 0) + m
                    times[gone] = 0
                total = np.bincount(word, times, size).astype(np.int64)
                keep = pc.and_(pa.array(total > 0), pc.greater_equal(pc.utf8_length(names), shortest))
                yield pa.RecordBatch.from_arrays([names.filter(keep).cast(pa.string()), pa.array(total).filter(keep)], ["word", "n"])
                if new:
                    yield pa.RecordBatch.from_arrays([pa.array(new.keys(), pa.string()), pa.array(new.values(), pa.int64())], ["word", "n"])

    found = docs.select("doc_id", "text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    with small_batches(docs.sparkSession, 2000):
        return stored(found.filter(F.col("n") >= least), "words")


def deletion_keys(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, place) of each word without its code point at each place, and of the word itself at place -1.

    A prefix's hash is the sum of its code points times powers of the base by place, so a deletion's is the prefix's plus
    the suffix's divided by the base, which is odd and so has an inverse among 64-bit numbers.
    """
    code = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4").astype(np.uint64)
    n = pc.utf8_length(words).to_numpy().astype(np.int64)
    firsts = np.cumsum(n) - n
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(code)) - firsts[row]
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(n.max(initial=0)), _BASE)]), dtype=np.uint64)
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(code * powers[place], dtype=np.uint64)])
    prefix = sums[:-1] - sums[firsts][row]
    suffix = sums[firsts + n][row] - sums[1:]
    whole = sums[firsts + n] - sums[firsts]
    key = np.concatenate([prefix + suffix * inverse, whole])
    key = key ^ (key >> np.uint64(29))
    key = key * np.uint64(0xBF58476D1CE4E5B9)
    key = (key ^ (key >> np.uint64(32))).view(np.int64)
    return key, np.concatenate([row, np.arange(len(n))]), np.concatenate([place, np.full(len(n), -1)])


def _key_rows(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 20_000):
            part = batch.slice(at, 20_000)
            key, row, place = deletion_keys(part.column(1))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(place.astype(np.int32)), part.column(0).take(pa.array(row))], ["key", "place", "id"])


def _shared(table: pa.Table) -> pa.Table:
    """Rows of keys that more than one word has."""
    key, word = table.column("key").to_numpy(), table.column("id").to_numpy()
    order = np.lexsort((word, key))
    key, word = key[order], word[order]
    begins = np.flatnonzero(np.diff(key, prepend=key[:1] - 1))
    ends = np.append(begins[1:], len(key))
    several = np.repeat(word[begins] != word[ends - 1], ends - begins)
    return table.take(pa.array(order[several]))


def _best_of(group: np.ndarray, n: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows in groups: how many others the row's group has, and the row of the first of these by falling n, then word (-1: none)."""
    order = np.lexsort((word, -n, group))
    sorted_ = group[order]
    begins = np.flatnonzero(np.diff(sorted_, prepend=sorted_[:1] - 1))
    size = np.diff(np.append(begins, len(group)))
    first = np.repeat(begins, size)
    own = np.arange(len(group))
    best = np.where(own == first, np.minimum(first + 1, len(group) - 1), first)
    best = np.where(np.repeat(size, size) > 1, order[best], -1)
    others, at = np.empty(len(group), np.int64), np.empty(len(group), np.int64)
    others[order], at[order] = np.repeat(size, size) - 1, best
    return order, others, at


def _near(table: pa.Table) -> pa.Table:
    """id, n_near, best_n, best_id that each row of a verified group adds."""
    place, word, n = (table.column(c).to_numpy() for c in ("place", "id", "n"))
    texts = [w if p < 0 else w[:p] + w[p + 1 :] for w, p in zip(table.column("word").to_pylist(), place.tolist())]
    text = pa.array(texts, pa.large_string()).dictionary_encode().indices.to_numpy().astype(np.int64)
    out = ([], [], [], [])

    def add(ids, others, best):
        some = others > 0
        for to, x in zip(out, (ids[some], others[some], n[best[some]], word[best[some]])):
            to.append(x)

    # replacements: the same string without the same place
    rows = np.flatnonzero(place >= 0)
    _, others, best = _best_of(text[rows] * (int(place.max(initial=0)) + 1) + place[rows], n[rows], word[rows])
    add(word[rows], others, rows[best])
    # insertions: the word that is the string, and each longer word once, however many of its places give the string
    whole = np.full(int(text.max(initial=-1)) + 1, -1)
    whole[text[place < 0]] = np.flatnonzero(place < 0)
    rows = rows[whole[text[rows]] >= 0]
    _, once = np.unique(np.stack([text[rows], word[rows]]), axis=1, return_index=True) if len(rows) else (None, rows)
    rows = rows[once]
    add(word[rows], np.ones(len(rows), np.int64), whole[text[rows]])
    order = np.lexsort((word[rows], -n[rows], text[rows]))
    first = np.flatnonzero(np.diff(text[rows][order], prepend=-1))
    short = whole[text[rows][order][first]]
    add(word[short], np.diff(np.append(first, len(rows))), rows[order][first])
    return pa.table([pa.array(np.concatenate(x).astype(np.int64)) for x in out], ["id", "n_near", "best_n", "best_id"])


def neighbours(words: DataFrame) -> DataFrame:
    """id, n_near, best_n, best_id of each of the words (id, word, n; ids in the words' order) that differs from another by one code point inserted, deleted or replaced.

    best: of the near words the one of largest n, then smallest id. Words are taken as distinct.
    """
    keys = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    parts = max(64, keys // KEYS)
    bits = (int(parts) - 1).bit_length()
    bucket = F.shiftrightunsigned("key", 64 - bits).cast("int")
    rows = words.select("id", "word").mapInArrow(_key_rows, "key long, place int, id long")
    rows = cut(rows.groupBy(bucket).applyInArrow(_shared, "key long, place int, id long"))
    rows = rows.join(small(words), "id").groupBy(bucket).applyInArrow(_near, "id long, n_near long, best_n long, best_id long")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best_id").alias("id")))
    return rows.groupBy("id").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("id", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.id").alias("best_id"))


def roots(forms: DataFrame, longest: int) -> DataFrame:
    """id, root: where forms (id, to) lead in the end, over at most `longest` steps."""
    at = forms.select("id", F.col("to").alias("root"))
    for _ in range(max(0, (longest - 1).bit_length())):
        at = cut(at)
        on = small(at.select(F.col("id").alias("root"), F.col("root").alias("further")))
        at = at.join(on, "root", "left").select("id", F.coalesce("further", "root").alias("root"))
    return at


def variants(docs: DataFrame, edited: int | None = EDITED, shortest: int = SHORTEST, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words that docs (doc_id, text) have often enough.

    form: the near word of largest n, ties by code points, if its n is at least `times` (2 or more) times the word's; else null.
    Null and empty texts have no words; repeated rows count each; without words there are no rows. Words of any length are
    taken whole. Other columns play no part.
    """
    words = numbered(counts(docs, edited, shortest, least), [F.col("word")], "id")
    found = words.join(cut(neighbours(words)), "id", "left")
    forms = cut(found.withColumn("to", F.when(F.col("best_n") >= times * F.col("n"), F.col("best_id"))))
    most = forms.agg(F.max("n")).first()[0] or 1
    linked = roots(forms.filter("to IS NOT NULL"), int(np.log2(most)) + 1)
    ends = linked.join(small(words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))), "root").select("id", "root_word")
    names = small(words.select(F.col("id").alias("to"), F.col("word").alias("form")))
    out = forms.join(names, "to", "left").join(small(cut(ends)), "id", "left")
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("to").isNotNull(), F.col("best_n")).alias("form_n"))
