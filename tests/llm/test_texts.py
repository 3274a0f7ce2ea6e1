"""Fill-in-the-middle, line dedup and the divergence audit against brute force, with odd rows."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import divergence as audit
from millrace.llm import fill_middle as fim
from millrace.llm import line_dedup

DDL = "doc_id long, text string, lang string, source string, output string, gone string, doc string, `a.b` string"


def frame(spark, rows):
    """Documents with extra columns whose names the operators also use; rows are (doc_id, text[, lang, source])."""
    full = [(r[0], r[1], *(r[2:] or ("en", "s")), "o", "g", "d", "ab") for r in rows]
    return spark.createDataFrame(full, DDL)


ODD = [None, "", "\n", "one", "a" * 50_000, "😀é́\U0001D11E" * 40, "x <P> y", "<M>", "ends with <", "P> starts", "$1 \\2 \\E", "same", "same"]


# --- fill in the middle

def cut_up(doc_id, text):
    """(form, prefix, middle, suffix) by slicing."""
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(text) + 1) for x in h[:2])
    plain = not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90
    return "plain" if plain else "spm" if h[3] % 100 < 20 else "psm", text[:a], text[a:b], text[b:]


def check_fill(rows, found):
    assert len(rows) == len(found)
    left = Counter()
    for doc_id, text, *_ in rows:
        form, p, m, s = cut_up(doc_id, text)
        out = {"plain": text or "", "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        sizes = (None, None) if form == "plain" else (len(p), len(m))
        left[(doc_id, len(text or ""), form, *sizes, out, text or "")] += 1
    assert left == Counter(tuple(r) for r in found)


def filled(df):
    out = fim.fill_middle(df)
    return out.select("doc.doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fim.restore(F.col("output"), F.col("form")))


def test_fill_middle_odd_rows(spark):
    rows = [(i + 40 * k, t) for k in range(6) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "one"), (3, "one")]
    found = filled(frame(spark, rows)).collect()
    check_fill(rows, found)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(st.sampled_from("aé😀<PSM>$\\\n\r\u0085 "), max_size=200), min_size=1, max_size=40))
def test_fill_middle_random(spark, texts):
    rows = list(enumerate(texts))
    check_fill(rows, filled(frame(spark, rows)).collect())


def test_fill_middle_counts_whole_units(spark):
    sizes = [0, 1, fim.UNIT - 1, fim.UNIT, fim.UNIT + 1, 10 * fim.UNIT, 10 * fim.UNIT + 63, 100_001]
    df = spark.createDataFrame([("😀" * n,) for n in sizes], "t string")
    assert [r[0] for r in df.select(fim.code_points(F.col("t"))).collect()] == sizes


def test_fill_middle_other_marks_and_empty_table(spark):
    marks = fim.Marks("<$p\\1>", "<|s|>", "<m.*>")
    df = frame(spark, [(i, f"text {i} (with) [signs] $0 \\") for i in range(50)])
    out = fim.fill_middle(df, marks=marks, changed=100, suffix_first=50)
    got = out.select("doc.text", fim.restore(F.col("output"), F.col("form"), marks).alias("back"), "output").collect()
    assert all(r["text"] == r["back"] and all(m in r["output"] for m in (marks.prefix, marks.suffix, marks.middle)) for r in got)
    assert fim.fill_middle(df.limit(0)).count() == 0
    for wrong in (("<P>", "<P>", "<M>"), ("P", "<S>", "<M>"), ("<P>x>", "<S>", "<M>"), ("<>", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fim.Marks(*wrong)


def test_fill_middle_is_one_scan(spark):
    plan = filled(frame(spark, [(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


# --- line dedup

def dedup(rows, least_chars=40, least_docs=5):
    """(doc_id, n_lines, n_dropped, kept) of each row."""
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip("\x20\x09\x0a\x0b\x0c\x0d"))
    holders = defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(doc_id)
    last = {k: max((d for d in own if d is not None), default=None) for k, own in holders.items() if len(own) >= least_docs}
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if last.get(key(x), doc_id) == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def lines_of(df, **options):
    return Counter(tuple(r) for r in line_dedup.drop_lines(df, **options).select("doc.doc_id", "n_lines", "n_dropped", "kept").collect())


LONG = "This line is long enough to be looked at, É and 😀 too."


def test_line_dedup_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [
        (100 + i, f"own line {i}\n\t{LONG if i % 2 else LONG.upper().replace('É', 'É')} \r\nlast {i}\n") for i in range(7)
    ]
    rows += [(200 + i, "\n".join([LONG] * 3)) for i in range(3)]  # the line alone, repeated within a document
    rows += [(None, f"{LONG}\nno id"), (None, f"{LONG}\nno id"), (202, "again\n" + LONG), (202, "again\n" + LONG)]
    rows += [(300 + i, "\x0b\x0c" + "y" * 40 + "\x1f") for i in range(4)] + [(300, "y" * 40 + "\x1f")]  # four documents only
    rows += [(400 + i, "z" * 39 + "\n" + " " * 45) for i in range(9)]  # too short; no-break spaces are no white space
    assert lines_of(frame(spark, rows)) == dedup(rows)


def test_line_dedup_threshold_and_keeper(spark):
    rows = [(i, LONG) for i in range(4)] + [(3, "x\n" + LONG)]
    assert lines_of(frame(spark, rows)) == dedup(rows) and sum(r[2] for r in dedup(rows)) == 0
    rows.append((4, LONG.replace("This", "tHIS")))  # only A-Z are compared without case
    assert lines_of(frame(spark, rows)) == dedup(rows) and sum(r[2] for r in dedup(rows)) == 5
    assert lines_of(frame(spark, rows), least_chars=1, least_docs=2) == dedup(rows, 1, 2)
    assert line_dedup.drop_lines(frame(spark, rows).limit(0)).count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(docs=st.lists(st.lists(st.sampled_from(["", " ab", "AB\t", "ab", "cd", "é", "É", "😀😀", "long line"]), max_size=6), min_size=1, max_size=30))
def test_line_dedup_random(spark, docs):
    rows = [(i % 20, "\n".join(own)) for i, own in enumerate(docs)]
    assert lines_of(frame(spark, rows), least_chars=2, least_docs=3) == dedup(rows, 2, 3)


def test_line_dedup_long_text_is_linear(spark):
    """A document of 60,000 lines, all shared: as many positions go, in one pass over them."""
    text = "\n".join(f"shared line number {i:08d} of a very long document" for i in range(60_000))
    rows = [(i, text) for i in range(5)]
    out = line_dedup.drop_lines(frame(spark, rows)).select("doc.doc_id", "n_dropped", F.length("kept").alias("left")).collect()
    assert sorted((r[0], r[1], r[2]) for r in out) == [(i, 60_000, 0) for i in range(4)] + [(4, 0, len(text))]


def test_line_dedup_is_native(spark):
    plan = line_dedup.drop_lines(frame(spark, [(1, LONG)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# --- divergence audit

def audited(rows, least_docs, top):
    """Brute force over dictionaries."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        sources = sorted(s for x, s in groups if x == lang)
        total = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (counts[lang, s][t] + 5) // (total[s] + 5 * len(kept)) for t in kept} for s in sources}
        whole = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
        q = {t: 1 + 10**9 * (whole[t] + 5) // (sum(whole.values()) + 5 * len(kept)) for t in kept}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, own, last in (("pair", pairs, None), ("term", terms, top)):
                own.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(own[:last])]
    return Counter(out)


def told(df):
    return Counter(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


WORDS = ["Alpha", "beta", "É", "é", "😀", "x9y", "don't", "ALPHA", "gamma_delta", "ß", "a", "b"]


def corpus(seed, n, sources):
    draw = np.random.default_rng(seed)
    return [
        (i, " ".join(draw.choice(WORDS, draw.integers(0, 9))), ["en", "de", None, ""][draw.integers(0, 4)], f"s{draw.integers(0, sources)}" if i % 7 else None)
        for i in range(n)
    ]


def test_divergence_odd_rows(spark):
    rows = corpus(1, 90, 4) + [(None, None, None, None), (0, "", "fr", "x"), (0, "zzz", "fr", "y"), (1, "alpha " * 20_000, "en", "s1"), (1, "a" * 3_000_000, "en", "s1"), (5, "alone", "it", "only")]
    for least in (1, 5):
        assert told(audit.divergence(frame(spark, rows), least_docs=least, top=3)) == audited(rows, least, 3)
    assert audit.divergence(frame(spark, rows).limit(0)).count() == 0


def test_divergence_over_many_blocks(spark, monkeypatch):
    """Few terms and sources a task, so that blocks of terms and pairs of blocks of sources add up."""
    monkeypatch.setattr(audit, "TERMS", 3)
    monkeypatch.setattr(audit, "SOURCES", 2)
    monkeypatch.setattr(audit, "HELD", 200)
    rows = corpus(2, 400, 9)
    assert told(audit.divergence(frame(spark, rows), least_docs=2)) == audited(rows, 2, 50)


def test_run_lengths_give_the_plain_sum():
    draw = np.random.default_rng(3)
    for n in (1, 2, 50, 1000):
        a, b = draw.integers(0, 4, n), draw.integers(0, 3, n)
        assert audit.distance(audit.runs(a), audit.runs(b), n) == int(np.abs(a - b).sum())


def test_probabilities_of_any_size():
    counts = np.array([0, 1, 10**9, 9 * 10**9, 10**13, 4 * 10**18])
    assert audit.probabilities(counts, 5 * 10**18, 7).tolist() == [1 + (int(c) + 5) * 10**9 // (5 * 10**18 + 35) for c in counts]
    assert audit.probabilities(counts[:2], 3, 7).tolist() == [1 + (int(c) + 5) * 10**9 // 38 for c in counts[:2]]


def test_terms_of_any_text():
    text = "".join(map(chr, range(1, 0x3000))) + "\x00A\x00B"
    want = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    assert [t.decode() for t in audit.terms(text.encode())] == want
