import random
import re
import zlib
from collections import Counter

import pytest

from punktwerk.llm import spelling


def words_of(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def near(words):
    words = sorted(words)
    return {(a, b) for a in words for b in words if distance_one(a, b)}


def brute(words):
    links = {}
    for a, b in near(words):
        links.setdefault(a, []).append(b)
    form = {}
    for w, n in words.items():
        best = min(links.get(w, []), key=lambda b: (-words[b], b), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(links.get(w, [])), words.get(form[w])))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def variants(rng, base, alphabet):
    k = rng.randrange(len(base))
    return rng.choice([base[:k] + base[k + 1:], base[:k] + rng.choice(alphabet) + base[k:], base[:k] + rng.choice(alphabet) + base[k + 1:]])


def test_chains_ties_and_slips(spark):
    rng = random.Random(2)
    text = []
    for base in ("letters", "Größe" * 2, "abcdef", "ÀÀÀÀÀÀ", "z" * 40):
        w, n = base, 700
        while n > 4:                    # a chain of forms, each a fifth as frequent
            text += [w] * n
            w, n = variants(rng, w, "abßé"), n // 5
    text += ["tiesaa"] * 6 + ["tiesab"] * 40 + ["tiesac"] * 40 + ["short"] * 50 + ["rareword"] * 4
    rng.shuffle(text)
    rows = [(i, " ".join(text[i::60]).replace("a", "A") if i % 2 else "×".join(text[i::60])) for i in range(60)]
    rows += [(None, None), (3, ""), (None, "letters " * 900), rows[4]]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n long").repartition(4)
    assert any(zlib.crc32(f"{d}:{w}".encode()) % 199 == 0 for d, t in rows for w in re.findall("[a-z]+", t or ""))
    assert result(spelling.spelling_forms(docs)) == brute(words_of(rows))


@pytest.mark.parametrize("limit", [1, 20, 10 ** 9])
def test_pairs_at_any_limit(spark, limit):
    """A third of the words share their first half, others their second one;
    refining the full keys gives the same pairs as joining them."""
    rng = random.Random(4)
    words = {"common" + "".join(rng.choice("abc") for _ in range(rng.randint(4, 6))) for _ in range(150)}
    words |= {"".join(rng.choice("xyz") for _ in range(rng.randint(4, 6))) + "ending" for _ in range(150)}
    words |= {"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(150)}
    found = spelling.near_pairs(spark.createDataFrame([(w,) for w in words], "word string"), limit).collect()
    assert len(found) == len(set(found))
    both = {(r["a"], r["b"]) for r in found} | {(r["b"], r["a"]) for r in found}
    assert both == near(words)


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert result(spelling.spelling_forms(docs)) == brute(words_of(rows))


def test_empty(spark, empty):
    assert spelling.spelling_forms(empty).count() == 0


def test_edge_rows(spark, edge):
    rows = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    assert result(spelling.spelling_forms(edge)) == brute(words_of(rows))
