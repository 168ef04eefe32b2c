"""Toxicity by a word classifier that is trained to score a sentence the same whichever group it names.

A logistic model over the presence of chosen marks: words, and beginnings of words (`xyz*`) that a text has twice or more
and at least once in DENSITY words, so that inflected and compounded forms count together and chance doesn't. Identity terms in labelled texts are swapped for others, and the
squared change of the score is added to the loss, so that a group's name carries no weight of its own. Beginnings that an
identity term has aren't marks, as no swap would reach them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, entering, texts_of

# Names of groups of people, in sets whose members can stand for each other in a sentence.
IDENTITY_TERMS = [
    ["muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "protestant", "atheist"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "catholics", "protestants", "atheists"],
    ["black", "white", "asian", "hispanic", "latino", "african", "european"],
    ["gay", "straight", "lesbian", "bisexual", "transgender", "queer", "heterosexual"],
    ["men", "women", "boys", "girls"],
    ["man", "woman", "boy", "girl"],
    ["american", "mexican", "chinese", "indian", "german", "french", "spanish", "turkish", "polish", "russian"],
    ["immigrant", "refugee", "foreigner", "native"],
    ["deaf", "blind", "disabled", "autistic"],
    ["blacks", "whites", "asians", "hispanics", "latinos", "africans", "europeans"],
    ["gays", "lesbians", "bisexuals", "queers", "heterosexuals"],
    ["americans", "mexicans", "indians", "germans", "turks", "poles", "russians"],
    ["immigrants", "refugees", "foreigners", "natives", "migrants"],
    # German
    ["muslime", "christen", "juden", "buddhisten", "katholiken", "protestanten", "atheisten"],
    ["muslimische", "christliche", "jüdische", "hinduistische", "buddhistische", "katholische", "protestantische", "atheistische"],
    ["schwarze", "weiße", "asiaten", "afrikaner", "europäer"],
    ["schwule", "lesben", "bisexuelle", "heterosexuelle", "homosexuelle"],
    ["männer", "frauen", "jungen", "mädchen"],
    ["amerikaner", "mexikaner", "chinesen", "inder", "deutsche", "franzosen", "spanier", "türken", "polen", "russen"],
    ["einwanderer", "flüchtlinge", "ausländer", "einheimische", "migranten"],
    ["gehörlose", "blinde", "behinderte", "autisten"],
    # French
    ["musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "catholiques", "athées"],
    ["musulman", "chrétien", "juif", "hindou", "bouddhiste", "catholique", "athée"],
    ["noirs", "blancs", "asiatiques", "africains", "européens"],
    ["homosexuels", "lesbiennes", "bisexuels", "hétérosexuels"],
    ["hommes", "femmes", "garçons", "filles"],
    ["américains", "mexicains", "chinois", "indiens", "allemands", "français", "espagnols", "turcs", "polonais", "russes"],
    ["immigrés", "réfugiés", "étrangers", "autochtones"],
    ["sourds", "aveugles", "handicapés", "autistes"],
    # Spanish
    ["musulmanes", "cristianos", "judíos", "hindúes", "budistas", "católicos", "protestantes", "ateos"],
    ["musulmán", "cristiano", "judío", "hindú", "budista", "católico", "ateo"],
    ["negros", "blancos", "asiáticos", "hispanos", "africanos", "europeos"],
    ["homosexuales", "lesbianas", "bisexuales", "heterosexuales"],
    ["hombres", "mujeres", "chicos", "chicas"],
    ["americanos", "mexicanos", "chinos", "indios", "alemanes", "franceses", "españoles", "turcos", "polacos", "rusos"],
    ["inmigrantes", "refugiados", "extranjeros", "nativos"],
    ["sordos", "ciegos", "discapacitados"],
]

#: Labelled rows that the model is fitted on at most; the smallest by a hash of doc_id.
MAX_LABELLED = 40_000
#: Marks that the model knows, the most telling of those in MIN_DOCS labelled texts at least.
MAX_WORDS, MIN_DOCS, MIN_CHI = 4096, 4, 30.0
#: Lengths of beginnings; one counts if it stands for one word in so many.
STEMS, DENSITY = (4, 5, 6, 7), 250
SWAPS = 3


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == 0, F.lit(False))


def _words(texts: pa.Array):
    """(document, word's code) of each word of each text, and the words: runs of letters in lower case."""
    lists = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{M}]+", " "))
    coded = lists.flatten().dictionary_encode()
    doc = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    return doc, coded.indices.to_numpy(), coded.dictionary.to_pylist()


def _marks(texts: pa.Array, number: dict[str, int], grow: bool = False):
    """(document, mark's number), once each, by document, of the marks in `number`; with grow, of all, which it takes in."""
    doc, code, names = _words(texts)
    owner, mark, stem = [], [], []
    for i, n in enumerate(names):
        for k in (0, *STEMS):
            if len(n) > k:
                m = f"{n[:k]}*" if k else n
                x = number.setdefault(m, len(number)) if grow else number.get(m, -1)
                if x >= 0:
                    owner.append(i)
                    mark.append(x)
                    stem.append(k > 0)
    owner, mark, stem = np.array(owner, np.int64), np.array(mark, np.int64), np.array(stem, bool)
    many = np.bincount(owner, minlength=len(names))
    first = np.cumsum(many) - many
    n = many[code] if len(names) else code
    at = np.repeat(first[code] - np.cumsum(n) + n, n) + np.arange(n.sum()) if len(names) else code
    key, times = np.unique(np.repeat(doc, n) << 32 | mark[at], return_counts=True)
    is_stem = np.zeros(len(number), bool)
    is_stem[mark[stem]] = True
    d, m = key >> 32, key & (1 << 32) - 1
    total = np.bincount(doc, minlength=len(texts))
    ok = ~is_stem[m] | (times >= 2) & (times * DENSITY >= total[d])
    return d[ok], m[ok]


def _present(texts: pa.Array, number: dict[str, int]):
    """As _marks, for a batch of any size."""
    docs, marks = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at, part in texts_of(texts):
        d, m = _marks(part, number)
        docs.append(d + at)
        marks.append(m)
    return np.concatenate(docs), np.concatenate(marks)


def labelled(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """doc_id, text, toxic of the labelled documents outside the held-out fold, `most` rows at most: the bound also bounds the broadcast.

    Of rows that share a doc_id one counts, that of the smallest hash of its text, so however often a labelled document
    stands in docs, it is one example.
    """
    rows = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    met = docs.select("doc_id", "text").join(F.broadcast(cut(rows)), "doc_id")
    return met.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("toxic").alias("toxic"))


def mark_counts(texts: DataFrame) -> DataFrame:
    """mark, toxic documents, other documents; summed by batch before it is shuffled."""

    def scan(batches):
        entering("toxicity")
        for batch in batches:
            toxic = batch.column("toxic").to_numpy()
            for at, part in texts_of(batch.column("text")):
                number: dict[str, int] = {}
                d, m = _marks(part, number, grow=True)
                n = np.bincount(m, minlength=len(number))
                b = np.bincount(m, toxic[d + at] == 1, minlength=len(number)).astype(np.int64)
                got = np.flatnonzero(n)
                names = pa.array(number, pa.string()).take(pa.array(got))
                yield pa.RecordBatch.from_arrays([names, pa.array(b[got]), pa.array((n - b)[got])], ["mark", "bad", "good"])

    return texts.select("text", "toxic").mapInArrow(scan, "mark string, bad long, good long").groupBy("mark").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def examples(texts: DataFrame, words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels, and numbers of the words that are present, of the labelled texts: bounded by their number and the words'."""
    number = {w: i for i, w in enumerate(words)}

    def scan(batches):
        for batch in batches:
            doc, word = _present(batch.column("text"), number)
            lists = [x.tolist() for x in np.split(word, np.searchsorted(doc, np.arange(1, batch.num_rows)))] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(lists, pa.list_(pa.int64()))], ["doc_id", "toxic", "words"])

    rows = texts.select("doc_id", "text", "toxic").mapInArrow(scan, "doc_id long, toxic int, words array<long>").collect()
    rows.sort(key=lambda r: (r.doc_id, r.toxic, r.words))
    return np.array([r.toxic for r in rows], float), [np.array(r.words, np.int64) for r in rows]


def swaps(present: list[np.ndarray], words: list[str], n: int = SWAPS, seed: int = 7) -> list[tuple[np.ndarray, np.ndarray]]:
    """(words that go, words that come) for each labelled text with identity terms, n times each."""
    number = {w: i for i, w in enumerate(words)}
    group = {number[w]: [number[x] for x in g if x in number] for g in IDENTITY_TERMS for w in g if w in number}
    rng, out = np.random.default_rng(seed), []
    for x in present:
        named = [w for w in x.tolist() if w in group]
        for _ in range(n if named else 0):
            come = [int(rng.choice([y for y in group[w] if y != w] or [w])) for w in named]
            out.append((np.setdiff1d(named, come), np.setdiff1d(come, x)))
    return out


def train(labels: np.ndarray, present: list[np.ndarray], words: list[str], fairness: float = 5.0, ridge: float = 0.02, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated gradient steps; classes weigh the same, so a score of a half parts them."""
    d, n = len(words), max(1, len(labels))
    row = np.repeat(np.arange(len(present)), [len(x) for x in present]).astype(np.int64)
    col = np.concatenate([*present, np.zeros(0, np.int64)])
    w_class = np.where(labels == 1, 0.5 / max(1.0, labels.sum()), 0.5 / max(1.0, (1 - labels).sum())) * n
    pairs = swaps(present, words)
    s_row = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b in pairs]).astype(np.int64)
    s_col = np.concatenate([*(np.concatenate(p).astype(np.int64) for p in pairs), np.zeros(0, np.int64)])
    s_sign = np.concatenate([*(np.concatenate([-np.ones(len(a)), np.ones(len(b))]) for a, b in pairs), np.zeros(0)])
    w, v, bias, v_bias = np.zeros(d), np.zeros(d), 0.0, 0.0
    for step in range(rounds):
        look, look_bias = w + 0.9 * v, bias + 0.9 * v_bias
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, look[col], len(labels)) + look_bias, -30, 30)))
        error = (p - labels) * w_class / n
        grad = np.bincount(col, error[row], d) + ridge / n * 20 * look
        if len(pairs):
            change = np.bincount(s_row, s_sign * look[s_col], len(pairs))
            grad += 2 * fairness / len(pairs) * np.bincount(s_col, s_sign * change[s_row], d)
        rate = 2.0 if not len(pairs) else 0.05
        v, v_bias = 0.9 * v - rate * grad, 0.9 * v_bias - rate * error.sum()
        w, bias = w + v, bias + v_bias
    return w, bias


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> dict:
    """A model: words, weights, bias. Marks are chosen by how far their documents are above the share of toxic ones."""
    texts = labelled(docs, labels, most)
    counts = mark_counts(texts)
    total = texts.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    bad, n = float(total[0] or 0), float(total[1])
    if not bad or bad == n:
        return {"words": [], "weights": [], "bias": -2.0 if not bad else 2.0}
    seen = F.col("bad") + F.col("good")
    expected = seen * F.lit(bad / n)
    identity = sorted({w for g in IDENTITY_TERMS for w in g})
    barred = identity + sorted({f"{w[:k]}*" for w in identity for k in STEMS if len(w) >= k})
    chi = F.pow(F.col("bad") - expected, 2) / (expected * F.lit(1 - bad / n))
    chosen = counts.filter((seen >= MIN_DOCS) & (F.col("bad") > expected) & (chi > MIN_CHI) & ~F.col("mark").isin(barred)).orderBy(chi.desc(), "mark").limit(MAX_WORDS)
    words = sorted(r[0] for r in chosen.select("mark").collect()) + identity
    y, present = examples(texts, words)
    weights, bias = train(y, present, words)
    return {"words": words, "weights": weights.tolist(), "bias": float(bias)}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score: from text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches):
        entering("toxicity")
        m = shared.value
        number, weights = {w: i for i, w in enumerate(m["words"])}, np.array(m["weights"])
        for batch in batches:
            doc, word = _present(batch.column("text"), number)
            z = np.bincount(doc, weights[word], batch.num_rows) if len(doc) else np.zeros(batch.num_rows)
            p = 1 / (1 + np.exp(-np.clip(z + m["bias"], -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(scan, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Null and empty texts get the score of a text without any known word; texts of any length count whole; a null doc_id
    is never held out; repeated rows get a row each, and a doc_id with several labels counts as toxic if one says so;
    without labels of both kinds every text gets the same score; an empty table gives none. Other columns of docs and
    labels play no part, whatever their names. Marks that tell as much are taken in their order as text.
    """
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
