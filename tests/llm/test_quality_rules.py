import re
from collections import Counter, defaultdict

import pytest

from punktwerk.llm import quality_rules as Q
from punktwerk.llm.queries import QUERIES
from tests.llm.conftest import SF, edge_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    cover = {j for k in range(len(w) - 7) if grams[tuple(w[k:k + 8])] > 1 for j in range(k, k + 8)}
    return dict(n_words=len(w), word_chars=sum(map(len, w)), n_symbols=len(re.findall(r"[#*$%&|<>]", t)),
                n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(cover), n_lines=len(lines),
                n_upper=len(re.findall("[A-Z]", t)), n_letters=len(re.findall("[A-Za-z]", t)),
                n_stutter=sum(a == b for a, b in zip(w, w[1:])))


def bin_of(r):
    e = r.bit_length() - 6
    return r if r < 64 else e * 32 + (r >> e)


def low(b):
    return b if b < 64 else (b - (b // 32 - 1) * 32) << (b // 32 - 1)


def failed(c):
    return c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]


def fences(cs, blend):
    """(lang, source, signal) -> fence, from the exact multiset of bins."""
    groups = defaultdict(list)
    for _, lang, source, c in cs:
        if not failed(c):
            for key in ((lang, source), (lang,), ()):
                groups[key].append(c)
    out = {}
    for key in [k for k in groups if len(k) == 2]:
        for s in Q.SIGNALS:
            def stats(k):
                v = sorted(bin_of(10000 * c[s.part] // max(1, c[s.whole])) for c in groups[k])
                mid, top = low(v[-(-len(v) // 2) - 1]), low(v[-(-s.high * len(v) // 100) - 1])
                return len(v), mid, top - mid
            _, mid, spread = stats(())
            whole = spread = max(min(spread, 2 * s.prior), s.prior // 2)
            for k in (key[:1], key):
                n, m, w = stats(k)
                w = max(min(w, 2 * min(whole, s.prior)), whole // 2)
                mid, spread = (n * m + blend * mid) // (n + blend), (n * w + blend * spread) // (n + blend)
            out[(*key, s.name)] = mid + s.reach * spread // 10
    return out


def verdicts(rows, blend):
    cs = [(i, lang, source, counts(t)) for i, t, lang, source in rows]
    limit = fences(cs, blend)
    out = []
    for i, lang, source, c in cs:
        kept = not failed(c)
        for s in Q.SIGNALS:
            f = limit.get((lang, source, s.name))
            kept = kept and (f is None or c[s.part] <= 2 or 10000 * c[s.part] // max(1, c[s.whole]) <= f)
        out.append((i, *(c[x] for x in Q.COUNTS[:5]), failed(c), kept))
    return sorted(map(repr, out))


def got(df):
    return sorted(repr((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept))
                  for r in df.collect())


def test_edge_cases(edge):
    rows = [(r[0], r[1], r[2], r[3]) for r in edge_rows()]
    for blend in (1, 8, 1000):
        assert got(Q.judge(edge, blend_docs=blend)) == verdicts(rows, blend)


def test_whole_table(spark, sf_docs):
    rows = list(sf_docs[["doc_id", "text", "lang", "source"]].itertuples(index=False))
    assert got(QUERIES["op3_quality_rules"](spark, SF)) == verdicts(rows, Q.BLEND_DOCS)


def test_labelled_documents(spark):
    """Junk goes, good documents stay (sf0.01 has enough labels)."""
    import duckdb
    lab = dict(duckdb.sql("select doc_id, quality from '/root/testdata/sf0.01/labels.parquet'").fetchall())
    rows = [r for r in QUERIES["op3_quality_rules"](spark, "/root/testdata/sf0.01").collect() if r.doc_id in lab and not r.base_failed]
    good = [r.kept for r in rows if lab[r.doc_id]]
    junk = [r.kept for r in rows if not lab[r.doc_id]]
    assert sum(good) / len(good) > 0.995 and sum(junk) / len(junk) < 0.1


def test_sketches_merge(edge):
    """The sketch of all rows is the sum of the sketches of two halves."""
    c = edge.select("doc_id", "lang", "source", Q.text_counts("text").alias("c")).select("doc_id", "lang", "source", "c.*")
    halves = Q.sketch(c.filter("doc_id % 2 = 0")).unionByName(Q.sketch(c.filter("doc_id % 2 = 1 or doc_id is null")))
    merged = halves.groupBy("lang", "source", "signal", "bin").sum("n")
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted(map(tuple, Q.sketch(c).collect()), key=repr)


def test_empty(empty):
    assert Q.judge(empty).count() == 0 and Q.keep_good(empty).count() == 0


def test_keep_good_keeps_columns(edge):
    out = Q.keep_good(edge)
    assert out.columns == edge.columns
    kept = sorted((r.doc_id or -1) for r in Q.judge(edge).filter("kept").collect())
    assert kept == sorted((r.doc_id or -1) for r in out.collect())


def corpus(junk_share, n=1500):
    """Prose with some symbols, capitals, doubled lines, repeats and stutters
    in it, two languages and three sources; one source has ``junk_share`` of
    documents spoilt in one of five ways."""
    import random
    rng = random.Random(7)
    vocab = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    rows, spoilt = [], {}
    for i in range(n):
        ws = [rng.choice(vocab) for _ in range(rng.randint(120, 260))]
        for k in range(0, len(ws), 12):
            ws[k] = ws[k].capitalize()
        if rng.random() < 0.1:
            ws[3:3] = ["&"] * rng.randint(1, 9)
        if rng.random() < 0.01:
            ws[50:50] = ws[20:20 + rng.randint(8, 10)]
        for k in range(rng.randint(0, 2)):
            ws.insert(10, ws[10])
        lines = [" ".join(ws[k:k + 10]) for k in range(0, len(ws), 10)]
        if rng.random() < 0.01:
            lines += lines[:1] * rng.randint(1, 2)
        source = ("clean", "mixed", "dirty")[i % 3]
        if source == "dirty" and rng.random() < junk_share:
            kind = spoilt[i] = ("symbols", "upper", "dup_lines", "repeats", "stutter")[i // 3 % 5]
            if kind == "symbols":
                lines = [w + " ### %% &&&" for w in lines]
            elif kind == "upper":
                lines = [x.upper() if k % 2 else x for k, x in enumerate(lines)]
            elif kind == "dup_lines":
                lines += ["- menu"] * (len(lines) * 2)
            elif kind == "repeats":
                lines[5:5] = [" ".join(ws[40:40 + len(ws) // 6]) + " so"]
            else:
                lines = [" ".join(y for x in line.split() for y in (x, x)[:1 + (len(x) > 6)]) for line in lines]
        rows.append((i, "\n".join(lines), "en" if i % 2 else "de", source))
    return rows, spoilt


@pytest.mark.parametrize("share", [0.0, 0.1, 0.4])
def test_junk_goes_whatever_its_share(spark, share):
    """Every signal fires; a source with 40 % junk loses it; good documents
    stay; the fences differ between the groups."""
    rows, spoilt = corpus(share)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got_ = {r.doc_id: r for r in Q.judge(df).collect()}
    assert got(Q.judge(df)) == verdicts(rows, Q.BLEND_DOCS)
    good = [got_[i].kept for i, *_ in rows if i not in spoilt]
    assert sum(good) / len(good) > 0.97
    if share >= 0.1:
        fired = {s.name: [i for i, r in got_.items() if not r.base_failed and getattr(r, f"max_{s.name}") is not None and r[s.part] > Q.LEAST_PART
                          and 10000 * r[s.part] // max(1, r[s.whole]) > r[f"max_{s.name}"]] for s in Q.SIGNALS}
        assert all(fired.values()), {k: len(v) for k, v in fired.items()}
        junk = [got_[i].kept for i in spoilt]
        assert sum(junk) / len(junk) < 0.15
        # a signal whose spreads all lie beyond a bound has one fence
        assert sum(len({r[f"max_{s.name}"] for r in got_.values()}) > 1 for s in Q.SIGNALS) >= 3


def test_equal_documents_stay(spark):
    """No spread at all: the prior's scale holds, few occurrences pass."""
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(i, text + " #" * (i % 3), "en", "s") for i in range(50)] + [(50, text + " ###" * 30, "en", "s")]
    got_ = {r.doc_id: r.kept for r in Q.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got_[i] for i in range(50)) and not got_[50]
