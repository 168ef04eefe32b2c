"""Documents with every awkward case, and brute-force versions of what the operators compute."""

import hashlib
import re

W = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n int, shingle string, sid long, key long, words string, `end` int, length int, _h int, _rich int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed: int, n: int) -> str:
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    out, x = [], seed * 7919 + 13
    for i in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(words[x % 20] + ("." if x % 11 == 0 else "") + str(x % 97 if x % 5 == 0 else ""))
    return " ".join(out)


def texts() -> list[tuple[int | None, str | None, str | None]]:
    """(doc_id, text, source)"""
    a, b = prose(1, 300), prose(2, 120)
    near = a.split()
    near[150] = "changed"
    far = a.split()
    far[::7] = ["other"] * len(far[::7])
    return [
        (1, a, "s1"), (2, a, "s1"), (2, a, "s1"), (3, " ".join(near), "s2"), (4, " ".join(far), "s2"), (5, None, None), (6, "", "s1"), (7, " \t\n ", "s3"), (8, b, None), (9, b.upper(), "s3"),
        (10, "one two", "s3"), (11, "ONE  two", "s3"), (12, "x " * 60_000, "s4"), (13, prose(3, 20_000), "s4"), (None, b, "s1"), (None, None, None), (14, "Straße ﬁne é ½", "s2"), (15, "STRASSE fine é 1⁄2", "s2"),
        (16, "mail a.b@c-d.example.com, +1 (555) 010-2345 and 4111 1111 1111 1111 at 10.0.0.255 or 10.0.0.256.1 @ x@y", "s2"), (17, "line\nline\nline\nother line here\n\n", "s1"), (18, "word " * 200, "s1"), (-5, "negative id", "s1"),
        (19, "日本語 текст ñandú <|endoftext|> İSTANBUL \x1c sep", "s5"), (20, "$$$ ### *** %%% &&& " * 30, "s5"),
    ]


def docs(spark):
    rows = [(i, t, "en", s, None if t is None else len(t), 1, "x", 2, 3, "w", 4, 5, 6, 7) for i, t, s in texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, n):
    w = W.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def components(rows, n, percent):
    """Position of each row -> smallest doc_id that links reach."""
    sets = [shingles(t, n) for _, t, _ in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                group[find(i)] = find(j)
    least = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(sets[i]), (least.get(find(i)) if sets[i] else d)) for i, (d, _, _) in enumerate(rows)]


def spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def joined(found):
    return ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in found)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
