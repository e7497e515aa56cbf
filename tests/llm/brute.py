"""Plain, slow versions of the corpus operators, and rows that are odd in every way."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def odd_documents(seed=5):
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared passages,
    nulls in every column, empty and long texts, repeated rows and ids."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    prose = lambda lines: "\n".join(sentence(rng.randint(6, 14)).capitalize() + "." for _ in range(lines))
    rows, shared, base = [], prose(4), prose(14)
    for k in range(40):
        text = prose(rng.randint(1, 12))
        if k % 5 == 0:
            text = text + "\n" + shared + "\n" + prose(2)
        rows.append((k, text, ["en", "fr"][k % 2], f"s{k % 4}"))
    for k in range(40, 70):  # near copies of one text
        tokens = base.split(" ")
        for _ in range(rng.randint(0, 5)):
            tokens[rng.randrange(len(tokens))] = rng.choice(vocabulary)
        rows.append((k, " ".join(tokens), "en", "hot"))
    rows += [(k, rows[3][1], "fr", "hot") for k in range(70, 76)]  # exact copies
    rows += [
        (80, None, "en", "s1"), (81, "", "fr", "s1"), (82, " \t\n\r ", "en", "s2"), (83, "one", "en", "s2"),
        (84, "one two three", None, "s2"), (85, "One  TWO three", "fr", None), (None, prose(5), "en", None),
        (None, None, None, None), (86, prose(6), "en", "s3"), (86, prose(6), "en", "s3"), (87, rows[1][1], "fr", "s3"),
        (88, "é ü ß Ж 漢字   x y", "en", "s0"), (89, "x" * 300, "en", "s0"), (90, "ab" * 400, "en", "s0"),
        (91, "1 2 3 !?", "fr", "s0"), (92, "\n\n\n\n", "fr", "s0"), (93, "A.\nA.\nA.\nA.\nA.\nA.", "fr", "s0"),
        (94, (sentence(4000) + "\n") * 2 + "z" * 5000, "en", "s3"), (95, shared, "en", "s1"), (96, shared + " tail", "en", "s1"),
    ]
    rows += [rows[2], rows[2], rows[45]]
    rng.shuffle(rows)
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


DOCUMENTS = pa.schema([
    ("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64()),
])


def write(path, rows, schema=DOCUMENTS, **extra):
    """One Parquet file of rows, with further columns of the same value."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    table = pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    for name, value in extra.items():
        table = table.append_column(name, pa.array([value] * len(rows), pa.string()))
    pq.write_table(table, path)
    return str(path)


def linked(rows):
    """Per row: its set of shingles, a number of its group, its links."""
    sets = [frozenset(tuple(w[i: i + 5]) for i in range(max(len(w) - 4, 1))) if (w := words(r[1])) else frozenset() for r in rows]
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    links = Counter()
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    return sets, [root(i) for i in range(len(rows))], links


def join(rows):
    """Per row: number of shingles, component, links."""
    sets, group, links = linked(rows)
    least = defaultdict(list)
    for r, g in zip(rows, group):
        if r[0] is not None:
            least[g].append(r[0])
    return [
        (r[0], len(sets[i]), min(least[group[i]], default=None) if sets[i] else r[0], links[i])
        for i, r in enumerate(rows)
    ]


def kept_of_groups(rows):
    """The row of the smallest id of each group, and all rows without words."""
    sets, group, _ = linked(rows)
    best = {}
    for r, s, g in zip(rows, sets, group):
        if s:
            best[g] = min(best.get(g, r), r, key=lambda x: (x[0] is None, x[0] or 0))
    return [*best.values(), *(r for r, s in zip(rows, sets) if not s)]


def suffix(rows, length=100):
    """Per row: bytes, removed, spans, digest of the rest. Rows that repeat id and
    text are one document."""
    order = sorted({(r[0] is None, r[0] or 0, r[0], r[1]) for r in rows}, key=lambda x: (x[0], x[1], x[3] is not None, x[3] or ""))
    seen, results = set(), {}
    for _, _, id_, text in order:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            w = raw[s: s + length]
            if w in seen:
                gone[s: s + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for k in range(len(raw)) if gone[k] and not (k and gone[k - 1]))
        results[id_, text] = (id_, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return [results[r[0], r[1]] for r in rows]


def counts(rows, folds, held_out):
    """Word counts, with None for ends, of the rows outside a fold."""
    total = Counter()
    for r in rows:
        if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % folds != held_out:
            total.update(words(r[1]))
            total[None] += 1
    return total


def in_order(rows):
    return sorted(map(repr, rows))
