"""Operators on documents against brute force, with odd rows: null, empty, long, repeated, clashing columns."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import components as components_of
from millrace.llm import harmonic, language, mixing, near_copies, packed_ids, surrogates, token_counts
from millrace.llm.components import components
from millrace.llm.encoding import WordEncoder
from millrace.llm.queries import QUERIES

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(WORDS)
DDL = "doc_id long, text string, lang string, source string, n_chars long, probability string, weight string, doc string"


def frame(spark, texts, ids=None):
    """Documents with extra columns whose names the operators also use."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "p", "w", "d") for i, t in zip(ids, texts, strict=True)], DDL)


ODD = [None, "", " \n\t", "one", "Two words", "x" * 30_000, "a b c d e f g", "a b c d e f g", "A B C D E F G", "é <|endoftext|> ½² don't"]


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def ids_of(text):
    return np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_words_encode_like_whole_texts(text):
    encoder = test_words_encode_like_whole_texts.__dict__.setdefault("encoder", WordEncoder(WORDS))
    assert encoder.by_word
    assert encoder.encode(text.encode()).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_words_encode_plain_characters():
    encoder, characters = WordEncoder(WORDS), [chr(c) for c in range(1, 0x250)]
    for text in ("".join(characters), " ".join(characters), " ".join(f"x{c}y" for c in characters), "L'Été <|startoftext|>x STRAẞE ΣΑΣ"):
        assert encoder.encode(text.encode()).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_small_word_memory_gives_the_same_ids(texts):
    encoder = WordEncoder(WORDS, words=50)
    for text in list(texts.values())[:20]:
        assert encoder.encode(text.encode()).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 32).flatmap(lambda b: st.tuples(st.just(b), st.lists(st.integers(0, (1 << b) - 1), max_size=300))))
def test_bit_packing_round_trip(case):
    bits, ids = case
    packed = packed_ids.pack(np.array(ids, np.uint32), bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    assert packed_ids.unpack(packed, len(ids), bits).tolist() == ids


def test_segment_random_access():
    docs = [np.arange(n, dtype=np.uint32) % 50_000 for n in (3, 0, 10_000, 1)]
    held = packed_ids.Segment(packed_ids.write_segment([5, None, 7, 8], docs, 17))
    assert [held.document(i).tolist() for i in range(4)] == [d.tolist() for d in docs]
    assert held.ids(4000, 4200).tolist() == np.concatenate(docs)[4000:4200].tolist()


def check_packed(rows, texts):
    start = 0
    expected = []
    for doc_id, text in texts:
        ids = ids_of(text)
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == sorted(expected)


def test_packed_ids_query(spark, texts):
    check_packed(QUERIES["op3_packed_ids"](spark, SF).collect(), sorted(texts.items()))


def test_packed_ids_odd_rows(spark):
    docs = frame(spark, ODD, [9 - i for i in range(len(ODD))])
    check_packed(packed_ids.packed_files(docs, WORDS).collect(), [(9 - i, t) for i, t in enumerate(ODD)][::-1])
    assert packed_ids.packed_files(docs.limit(0), WORDS).collect() == []
    twice = packed_ids.packed_files(frame(spark, ["a b", "a b", "c"], [1, 1, None]), WORDS).collect()
    assert sorted((r.doc_id is None, r.start) for r in twice) == [(False, 2), (False, 5), (True, 0)]


def check_pieces(rows, texts, capacity=2048):
    own, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    assert set(own) == set(texts)
    for doc_id, pieces in own.items():
        ids, at = ids_of(texts[doc_id]), 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    used = []
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        used.append(at)
    assert max(used, default=0) <= capacity
    return sum(capacity - u for u in used if u & (u - 1)) / max(1, sum(used))


def test_packing_query(spark, texts):
    assert check_pieces(QUERIES["op8_harmonic_packing"](spark, SF).collect(), texts) < 0.05


def test_packing_odd_rows_and_levels(spark, monkeypatch):
    monkeypatch.setattr(harmonic, "FAN_IN", 2)
    docs = frame(spark, ODD * 8, range(8 * len(ODD))).repartition(7)
    rows = harmonic.packing_digests(harmonic.pack_documents(docs, WORDS)).collect()
    check_pieces(rows, dict(enumerate(ODD * 8)))
    assert harmonic.pack_documents(docs.limit(0), WORDS).collect() == []


@given(st.integers(1, 100_000))
def test_cuts_fill_their_class(length):
    parts = harmonic.cuts(length)
    assert sum(parts) == length
    assert all(0 < p <= 2048 and 2048 % p <= max(2048 * harmonic.WASTE, 2048 // p) for p in parts)


def test_token_counts_and_their_cache(spark, scratch, monkeypatch):
    from sentencepiece import SentencePieceProcessor

    library, cache = SentencePieceProcessor(model_file=PIECES), f"{scratch}/cache"
    docs = frame(spark, [*ODD, "x " * 5000])
    expected = sorted((i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in enumerate([*ODD, "x " * 5000]))
    rows = token_counts.count_tokens(docs, PIECES, cache).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in rows) == expected
    assert sorted(r.doc_id for r in rows if r.over_limit) == sorted(i for i, _, n in expected if n > 4096) != []
    stored = spark.read.parquet(cache).count()
    assert stored == len({t or "" for t in ODD}) + 1
    again = token_counts.count_tokens(docs.union(frame(spark, ["new"], [99])), PIECES, cache).collect()
    assert len(again) == len(rows) + 1 and spark.read.parquet(cache).count() == stored + 1
    assert token_counts.count_tokens(docs.limit(0), PIECES, f"{scratch}/none").collect() == []
    other = token_counts.count_tokens(docs, WORDS, cache).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in other) == [(i, len(ids_of(t)) - 1) for i, t in enumerate([*ODD, "x " * 5000])]


def test_language_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op4_language_id"](spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    own = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in own) >= 0.97 * len(own)


def test_language_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs)
    got = {r.doc_id: r for r in language.identify(frame(spark, [*ODD, "12 !! .. ½²", "é"]), model).collect()}
    assert [got[i].lang_pred for i in (0, 1, 2, len(ODD))] == ["und"] * 4 and got[0].score == 0
    assert got[len(ODD) + 1].lang_pred in model.languages or got[len(ODD) + 1].lang_pred in ("en", "de", "fr", "es")
    nothing = language.train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
    one = language.train(docs.where("lang = 'en'"))
    assert {(r.lang_pred, r.score) for r in language.identify(frame(spark, ["word"]), one).collect()} == {("en", 1.0)}
    assert language.identify(docs.limit(0), model).collect() == []
    passed = language.label_documents(frame(spark, ["the word"]), model)
    assert passed.select("doc.*").columns == frame(spark, ["x"]).columns


def shingle_sets(texts):
    out = {}
    for k, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        out[k] = {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    return out


def brute_components(sets):
    holders, common, up = defaultdict(list), Counter(), {k: k for k in sets}
    for k, own in sets.items():
        for s in own:
            holders[s].append(k)
    for own in holders.values():
        for i, a in enumerate(own):
            for b in own[:i]:
                common[(min(a, b), max(a, b))] += 1

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return {k: find(k) for k in sets}


def check_copies(rows, texts):
    sets = shingle_sets(texts)
    expected = brute_components(sets)
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows) == sorted(
        (k, len(s), expected[k], expected[k] == k) for k, s in sets.items()
    )


def test_near_copies_query(spark, texts):
    check_copies(QUERIES["op9_near_copies"](spark, SF).collect(), texts)


@pytest.mark.parametrize("block", [1024, 6])
def test_near_copies_groups_chains_and_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    base = [f"w{i}" for i in range(60)]
    rows = list(ODD)
    for i in range(25):  # a chain: each next to its neighbours, far from the ends
        rows.append(" ".join(base[i * 2:] + [f"n{j}" for j in range(i * 2)]))
    rows += [" ".join([*base[:55], f"e{i}"]) for i in range(20)] + ["same text of six whole words"] * 5
    check_copies(near_copies.near_copies(frame(spark, rows)).collect(), dict(enumerate(rows)))
    assert near_copies.near_copies(frame(spark, rows).limit(0)).collect() == []
    twice = near_copies.near_copies(frame(spark, ["a b", "c d", "c d", None], [3, 3, 1, None])).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in twice) == [(0, None), (1, 1), (3, 1), (3, 1)]


def test_words_hash_alike_beside_a_long_word():
    shingler, rng = near_copies.Shingler(), np.random.default_rng(5)
    blob = rng.choice(list(b"abcdefghijklmnopqrstuvwxyz0123456789+/"), 5 << 20).astype(np.uint8).tobytes()
    prose = b" ".join(b"w%d" % i for i in rng.integers(0, 10**6, 110_000))
    plain, last = shingler.shingles(prose), None
    for text in (prose + b" " + blob, prose[:70_000] + b" " + blob + prose[70_000:], prose + b" " + blob[:2 << 20], b"  " + blob + b" \n" + prose):
        own = shingler.shingles(text)
        assert len(np.intersect1d(plain, own)) >= len(plain) - 2 * near_copies.WORDS and near_copies.alike(plain, own)
    for before in (b"", b" ", b"a b ", b"x " * 300_000, b"\n" * ((4 << 20) - 1), b"\n" * (4 << 20)):
        words = shingler._words(before + blob + b" end")
        assert last is None or words[-2:].tolist() == last
        last = words[-2:].tolist()


def test_pieces_of_any_size_give_the_same_words(monkeypatch):
    text = b"ab  cdefghij k\n" * 3 + b"lmnopqrstuvw "
    whole = near_copies.Shingler()._words(text).tolist()
    for size in range(1, len(text) + 1):
        monkeypatch.setattr(near_copies, "_PIECE", size)
        assert near_copies.Shingler()._words(text).tolist() == whole, size


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(3)
    off = []
    for _ in range(60):
        items = rng.integers(0, 1 << 63, 300).astype(np.uint64)
        a, b = near_copies.signatures([np.sort(items[:240]), np.sort(items[60:])])
        off.append((a == b).mean() - 180 / 300)
    assert abs(np.mean(off)) < 0.015 and np.std(off) < np.sqrt(0.6 * 0.4 / near_copies.SLOTS) * 1.15
    few = near_copies.signatures([np.array([5], np.uint64), np.zeros(0, np.uint64)])
    assert sorted(np.floor(few[0])) == list(range(near_copies.SLOTS)) and np.isinf(few[1]).all()


@pytest.mark.parametrize("one_task", [200_000, 5])
def test_components_of_paths_and_stars(spark, monkeypatch, one_task):
    monkeypatch.setattr(components_of, "ONE_TASK", one_task)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 30)] + [(3, 3), (None, 4), (50, 60), (60, 50)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long").repartition(6)).distinct().collect())
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in range(7, 30)}, 50: 50, 60: 50}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_every_label_is_learned(spark):
    rng, rows = np.random.default_rng(3), []
    for k in range(70):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)]
        rows += [(100 * k + i, " ".join(rng.choice(words, 20)), f"q{k:02d}") for i in range(30 if k < 64 else 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    assert len(model.languages) == 70
    found = language.identify(docs, model).where("held_out").join(docs, "doc_id").collect()
    assert {r.lang for r in found} == {r.lang_pred for r in found} and all(0 < r.score <= 1 for r in found)
    assert sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)


CARD, NOT_CARD = "4417744280351547", "9807915762804490"


def test_surrogates_of_each_kind(spark):
    rows = [
        "Mail Ann.Lee30@mail2.example.com or ANN.LEE30@MAIL2.EXAMPLE.COM.", "call +1 (017) 555-7713 or (017) 555-7713",
        f"cards {CARD} {NOT_CARD}", "ip 97.51.17.173 not 999.1.1.1 nor v1.2.3", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"',
        "Mrs. Anna Schmidt and Mr Schmidt met Господин Иванов", None, "", "clean 12 words of 2024", f"again {CARD}",
    ]
    got = {r.doc_id: r for r in surrogates.replace_entities(frame(spark, rows), "key").collect()}
    text = {k: r.text for k, r in got.items()}
    assert [text[k] for k in (6, 7, 8)] == [None, "", rows[8]]
    a, b = re.findall(r"\S+@[\w.]+\w", text[0])
    assert a.upper() == b and a != "Ann.Lee30@mail2.example.com".lower()
    one, two = re.fullmatch(r"call \+1 (\(\d{3}\) \d{3}-\d{4}) or (\(\d{3}\) \d{3}-\d{4})", text[1]).groups()
    assert one == two != "(017) 555-7713"
    card = re.fullmatch(rf"cards (4\d{{15}}) {NOT_CARD}", text[2])[1]
    assert card != CARD and text[9] == f"again {card}"
    assert sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(card))) % 10 == 0
    assert re.fullmatch(r"ip (\d+\.){3}\d+ not 999\.1\.1\.1 nor v1\.2\.3", text[3]) and "97.51.17.173" not in text[3]
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', text[4]) and text[4] != rows[4]
    female, male, cyrillic = re.fullmatch(r"Mrs\. (\w+) \w+ and Mr (\w+) met Господин (\w+)", text[5]).groups()
    assert female in surrogates.GIVEN["Latin"]["f"] and re.fullmatch("[а-яА-Я]+", cyrillic) and male != "Schmidt"
    assert {k: n for k, n in got[5]["__pii_counts"].items() if n} == {"name": 3}
    assert got[0].asDict().keys() - {"__pii_counts"} == set(frame(spark, ["x"]).columns) and got[0].probability == "p"
    other = {r.doc_id: r.text for r in surrogates.replace_entities(frame(spark, rows), "another").collect()}
    assert other[2] != text[2]
    assert surrogates.replace_entities(frame(spark, rows).limit(0), "key").collect() == []


def test_secrets_and_names_go_to_their_end(spark):
    long = "".join("abcdefghij0123456789"[i * i % 20] for i in range(1000))
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9P"
    huge = "Ab1." * 50_000 + "Z"
    rows = [
        f'token = "{long}" end', f"token = {jwt}. Next", "api_key: abcdefghij~klmnop.qr+st== end", "Dr Anna Maria Sofia Schmidt went",
        f"Mr {'A' + 'b' * 60} went", "password: ........................ 7", f"secret={huge}",
    ]
    got = {r.doc_id: r for r in surrogates.replace_entities(frame(spark, rows), "key").collect()}
    assert re.fullmatch(r'token = "[a-z0-9]{1000}" end', got[0].text) and not any(long[i:i + 12] in got[0].text for i in range(0, 988))
    assert [len(x) for x in got[1].text.split(".")] == [len(x) for x in rows[1].split(".")] and got[1].text.endswith(". Next") and not any(x in got[1].text for x in jwt.split("."))
    assert re.fullmatch(r"api_key: [a-z]{10}~[a-z]{6}\.[a-z]{2}\+[a-z]{2}== end", got[2].text) and "qr+st" not in got[2].text
    assert re.fullmatch(r"Dr \w+ \w+ went", got[3].text) and not re.search("Sofia Schmidt|Schmidt", got[3].text)
    assert re.fullmatch(r"Mr \w+ went", got[4].text) and "bbbb" not in got[4].text
    assert got[5].text == rows[5] and len(got[6].text) == len(rows[6]) and got[6].text[-8:] != rows[6][-8:]
    assert [got[i]["__pii_counts"]["secret"] for i in range(7)] == [1, 1, 1, 0, 0, 0, 1]


def test_phones_of_other_countries_and_short_cards(spark):
    found = [
        "+49 30 1234567", "+44 20 7946 0958", "+33 1 23 45 67 89", "+493012345678", "+351-21-123.4567", "+49 (0)30/1234567", "+358 9 12345",
        "+49 301 555 7713 88", "312 345 6789", "+1 312 345 6789", "+1 3123456789", "3782 822463 10005", "3782-822463-10005",
    ]
    stay = ["3782 822463 10006", "id 3012345678 of 1700000000", "+12345 and 1+1234567", "12 345 678"]
    rows = [*(f"call {x}, now" for x in found), *stay, "(+49 30 1234567) or +49-30-1234567"]
    got = {r.doc_id: r for r in surrogates.replace_entities(frame(spark, rows), "key").collect()}
    new = [re.fullmatch(r"call (.*), now", got[i].text)[1] for i in range(len(found))]
    digits = [re.sub(r"\D", "", x) for x in new]
    for old, now in zip(found, new, strict=True):
        assert re.sub(r"\d", "0", old) == re.sub(r"\d", "0", now) and old[-4:] != now[-4:]
    assert [x[:n] for x, n in zip(new, (3, 3, 3, 3, 4, 3, 4, 3), strict=False)] == ["+49", "+44", "+33", "+49", "+351", "+49", "+358", "+49"]
    assert digits[8] == digits[9][1:] == digits[10][1:] != digits[2][1:] and digits[11] == digits[12]
    assert digits[11][0] == "3" and sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(digits[11]))) % 10 == 0
    assert [got[len(found) + i].text for i in range(len(stay))] == stay
    assert got[len(rows) - 1].text == f"({new[0]}) or {new[0].replace(' ', '-')}"
    assert [got[i]["__pii_counts"]["phone"] for i in range(len(rows))] == [1] * 11 + [0] * 6 + [2]


def test_surrogates_stay_distinct_in_a_small_space(spark):
    mails = [f"{c}@x.de" for c in "abcdefghijklmnopqrstuvwxyz"] + ["a@y.de"]
    got = [r.text for r in surrogates.replace_entities(frame(spark, mails), "k").collect()]
    assert len(set(got)) == len(mails) and not set(got) & set(mails)


def test_long_text_without_entities_is_quick(spark):
    text = "a" * 400_000 + " 1 " + "b." * 100_000
    assert surrogates.replace_entities(frame(spark, [text]), "k").first().text == text


def test_mixing_meets_margins_and_part(spark):
    rows = [(i, "x" * 40, "en" if i % 3 else None, f"s{min(i % 7, 3)}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("weight", F.lit("clash"))
    categories = {"source": F.col("source"), "lang": F.col("lang")}
    targets = {"source": {"s0": 1, "s1": 1, "s2": 1, "s3": 1, "absent": 5}, "lang": {"en": 3, "": 1}}
    mixed = mixing.mix_documents(docs, categories, targets, 0.3).collect()
    assert len(mixed) == len(rows) and mixed[0].doc.weight == "clash"
    expected = sum(r.weight * r.probability for r in mixed)
    assert expected == pytest.approx(0.3 * 10 * 4000, rel=1e-4)
    by = Counter()
    for r in mixed:
        by[r.source] += r.weight * r.probability / expected
        by[r.lang] += r.weight * r.probability / expected
    assert all(by[k] == pytest.approx(v, abs=1e-4) for k, v in {"s0": 0.25, "s3": 0.25, "en": 0.75, "": 0.25}.items())
    assert sum(r.sampled for r in mixed) == pytest.approx(0.3 * 4000, rel=0.1)
    assert mixing.mix_documents(docs.limit(0), categories, targets).collect() == []


def test_mixing_takes_scarce_cells_whole(spark):
    rows = [(i, "x" * 40, "a" if i < 10 else "b") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix_documents(docs, {"source": F.col("source")}, {"source": {"a": 1, "b": 1}}, 0.5).collect()
    assert {r.probability for r in mixed if r.source == "a"} == {1.0}
    assert sum(r.weight * r.probability for r in mixed) == pytest.approx(5000, rel=1e-4)


def test_smallest_hashes_keep_every_link():
    rng = np.random.default_rng(8)
    for size in (40, 256, 900):
        for _ in range(40):
            items = rng.integers(0, 1 << 63, 2 * size).astype(np.uint64)
            shared = rng.integers(size // 2, size)
            sets = [np.sort(items[:size]), np.sort(np.concatenate([items[:shared], items[size:2 * size - shared]]))]
            held = np.full((2, near_copies.LEAST), near_copies._NONE)
            for i, own in enumerate(sets):
                held[i, :len(own[:near_copies.LEAST])] = own[:near_copies.LEAST]
            told = near_copies.fits(held[0], size, held[1:], np.array([size]))[0]
            linked = near_copies.alike(*sets)
            assert told >= linked and (told == linked or size > near_copies.LEAST)


def test_secrets_with_any_characters_and_long_addresses(spark):
    rows = [
        'password="abcdefghijklmnop12!REST_of_secret" end', 'password = "P@ssw0rd!longer#than16chars"', "passwd: 'ab c1'.", "token=Zx9$kq#1, next",
        '{"api_key":"k&1:2*3","x":1}', f"mail {'l' * 90}@x.org now", "a@b.c.d.e.f.g.h.i.j.kk.org", "secret: he left", 'password = "' + "é1 ☃" * 9 + '"',
        "token = " + "a\U0001F600" * 30_000 + "1", "The password: swordfish was", 'secret = ""', "access_key=0123456789abcdef!.",
    ]
    got = {r.doc_id: r for r in surrogates.replace_entities(frame(spark, rows), "key").collect()}
    new = [got[i].text for i in range(len(rows))]
    assert not any(old in now for now, parts in zip(new, (
        ["REST_of", "abcdefgh"], ["P@ss", "longer", "than16"], ["ab c1"], ["Zx9", "kq#1"], ["k&1"], ["llll"], ["a@b", "kk.org@"], [], ["é1"], ["a\U0001F600a\U0001F600a"], [], [], ["0123456789abcdef"],
    ), strict=True) for old in parts)
    assert new[7] == rows[7] and new[10] == rows[10] and new[11] == rows[11]
    assert re.fullmatch(r"token=\w\w\d\$\w\w#\d, next", new[3]) and re.fullmatch(r"passwd: '\w\w \w\d'\.", new[2])
    assert re.fullmatch(r'\{"api_key":"\w&\d:\d\*\d","x":1\}', new[4]) and new[0].endswith('" end') and re.fullmatch(r"access_key=\w{16}!\.", new[12])
    assert new[6].count(".") == rows[6].count(".") and new[6].endswith(".org")


def test_a_full_space_is_widened(spark):
    """More numbers of a country code than seven digits leave: the rest get an extension, none twice."""
    rows = spark.range(12_000).select(F.lit("phone").alias("kind"), F.format_string("+380%04d", "id").alias("norm"), F.lit("").alias("gender"))
    rows = rows.where("length(norm) = 8")
    got = surrogates.surrogate_table(rows, "k").collect()
    made = {r["surrogate"] for r in got}
    assert len(got) == len(made) == 10_000 and any("x" in s for s in made)
    assert not {s for s in made if "x" not in s} & {r["norm"] for r in got}
    shown = spark.sql(f"SELECT {surrogates._shown('kind', 'raw', 'norm', 'new')} FROM VALUES ('phone', '+380 12-34', '+3801234', '+3805678x91') t(kind, raw, norm, new)")
    assert shown.first()[0] == "+380 56-78x91"


def test_cards_need_an_issuer(spark):
    def card(start, n):
        body = start + "0" * (n - len(start) - 1)
        total = sum(int(c) if i % 2 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(reversed(body)))
        return body + str(-total % 10)

    cards = [card(*x) for x in (("4", 13), ("4", 16), ("5105", 16), ("2221", 16), ("371", 15), ("3056", 14), ("3530", 16), ("6011", 16), ("62", 17))]
    other = [card(*x) for x in (("9", 16), ("0", 16), ("1", 16), ("2000", 16), ("35", 14), ("7", 16), ("8", 13))]
    got = {r.doc_id: r for r in surrogates.replace_entities(frame(spark, [f"no {x} end" for x in cards + other]), "key").collect()}
    assert [got[i]["__pii_counts"]["card"] for i in range(len(got))] == [1] * len(cards) + [0] * len(other)
    assert all(got[i].text[:7] == f"no {c[:4]}" and c not in got[i].text for i, c in enumerate(cards))


def test_every_detected_entity_goes_and_clean_texts_stay(spark, texts):
    """An independent detector, written for plain forms only, over the whole table."""
    def luhn(x):
        return sum(int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(reversed(x))) % 10 == 0

    def found(text):
        words = [w.strip(".,;:!?()[]\"'") for w in (text or "").split()]
        out = {w for w in words if w.count("@") == 1 and "." in w.split("@")[1]}
        out |= {w for w in words if w.count(".") == 3 and all(p.isdigit() and int(p) < 256 for p in w.split("."))}
        out |= {w for w in words if len(w) == 16 and w[0] == "4" and w.isdigit() and luhn(w)}
        out |= {a.strip("\"'") for n, eq, a in zip(words, (text or "").split()[1:], words[2:], strict=False) if n.lower() == "token" and eq == "=" and len(a) >= 16}
        return out | {f"{a} {b}" for a, b in zip(words, words[1:], strict=False) if re.fullmatch(r"\(?\d{3}\)?", a) and re.fullmatch(r"\d{3}-\d{4}", b)}

    everything = set().union(*map(found, texts.values()))
    got = {r.doc_id: r.text for r in QUERIES["op6_surrogates"](spark, SF).collect()}
    assert len(got) == len(texts) and len(everything) > 5
    left = {d: found(t) & everything for d, t in got.items()}
    assert not any(left.values())
    hints = re.compile(r"@|\d{3}|(?i:token|secret|passw|key)|\b(?:Mrs?|Ms|Miss|Dr|Prof|Frau|Herr|M[mel]{2,3}|Madame|Monsieur|Se\w+|Sra?|Г\w+|К\w+)\b")
    clean = [d for d, t in texts.items() if not hints.search(t or "")]
    assert len(clean) > 20 and all(got[d] == texts[d] for d in clean)


def test_cells_of_a_round_are_written(spark):
    from millrace.llm.mixing import fit

    cells = spark.createDataFrame([("a", "x", 10), ("a", "y", 30), ("b", "x", 20), ("b", "y", 40)], "s string, l string, mass bigint")
    fitted = fit(cells, {"s": 0.5, "l": 0.5}, tolerance=0.0, rounds=2)
    assert "Join" not in fitted._jdf.queryExecution().toString() and fitted.count() == 4
