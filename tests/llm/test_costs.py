"""What operators do once rather than for each row or word."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spanloom.llm import jaccard, tokens, toxicity

WORDS = ["cart", "Cartons,", "checkout", "(checkouts)", "ab", "a", "x1y2", "日本語", "Ärzte", "don't", "w" * 70, "w" * 70 + "cart", "carte"]


def test_near_copies_meet_by_bundles(make_docs, monkeypatch):
    rng = random.Random(3)
    long = [f"word{rng.randrange(10**6)}" for _ in range(1500)]
    texts = [" ".join(long), " ".join(long[:700] + ["other"] + long[700:]), "a short text of its own " * 3]
    met = []
    plain = jaccard._candidates

    def counted(rows, percent):
        met.append(rows.groupBy("x.g", "y.g").agg(F.count(F.lit(1)).alias("n"), F.sum("x.w").alias("w")).collect())
        return plain(rows, percent)

    monkeypatch.setattr(jaccard, "_candidates", counted)
    got = {r.doc_id: r.component_id for r in jaccard.link_classes(make_docs(texts), 5, 80).collect()}
    assert len(set(got.values())) == 2
    (pair,) = met[-1]
    assert pair.n == 1 and pair.w > 100


def test_long_variants_that_are_not_similar_do_not_meet(make_docs, monkeypatch):
    rng = random.Random(5)
    source = [f"word{rng.randrange(10**6)}" for _ in range(1030)]

    def variant(changes, less=0):
        words = list(source[less:])
        for at in rng.sample(range(len(words)), changes):
            words[at] = f"other{rng.randrange(10**6)}"
        return words

    # similar to none of the others, and two close to one of them, the longer on the other side of 1,024 shingles
    crowd = [variant(17) for _ in range(24)]
    near = [[*crowd[3][:-12]], [*crowd[3][:500], "between", *crowd[3][500:]]]
    texts = [" ".join(words) for words in crowd + near]
    met = []
    plain = jaccard._other_classes

    def counted(*args):
        rows = plain(*args)
        met.append((rows.count(), rows.select("x.g", "y.g").distinct().count()))
        return rows

    monkeypatch.setattr(jaccard, "_other_classes", counted)
    got = {r.doc_id: r.component_id for r in jaccard.link_classes(make_docs(texts), 5, 80).collect()}
    sets = [set(zip(*(words[k:] for k in range(5)), strict=False)) for words in crowd + near]
    wanted = {i: i for i in range(len(sets))}
    for i in range(len(sets)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                wanted = {n: min(wanted[i], wanted[j]) if c in (wanted[i], wanted[j]) else c for n, c in wanted.items()}
    assert got == wanted and len(set(wanted.values())) == 24
    assert met[-1][1] < 30  # of 325 pairs


def test_variants_of_one_prefix_meet_only_if_signatures_are_near(make_docs, monkeypatch):
    rng = random.Random(11)
    source = [f"word{rng.randrange(10**6)}" for _ in range(150)]
    crowd = [list(source) for _ in range(150)]
    for words in crowd:
        for at in rng.sample(range(len(words)), 3):
            words[at] = f"other{rng.randrange(10**6)}"
    crowd += [[*words[:-2], "end"] for words in crowd[:5]]
    texts = [" ".join(words) for words in crowd]
    met, sizes = [], []
    plain, candidates = jaccard._other_classes, jaccard._hub_pairs

    def counted(*args):
        rows = plain(*args)
        met.append(rows.select("x.g", "y.g").distinct().count())
        return rows

    def hubs(postings, percent):
        sizes.append(postings.agg(F.max("size")).first()[0])
        return candidates(postings, percent)

    monkeypatch.setattr(jaccard, "_other_classes", counted)
    monkeypatch.setattr(jaccard, "_hub_pairs", hubs)
    got = {r.doc_id: r.component_id for r in jaccard.link_classes(make_docs(texts), 3, 90).collect()}
    assert got == {i: i - 150 if i >= 150 else i for i in range(155)}
    assert sizes[0] >= 2  # some have one prefix
    assert met[-1] < 20  # of 11,935 pairs


def test_longer_signatures_of_two_lengths(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(-(2**63), 2**63 - 1, 2200)
    rows, differ = [], []
    for x, y in ((base[:1020], base[:1040]), (base[:1040], base[20:1030]), (base[:2000], base[100:2100]), (base[:100], base[:101]), (base[:120], base[:140])):
        fars = [jaccard.parity(np.sort(s), w).tolist() if (w := jaccard.far_words(len(s))) else None for s in (x, y)]
        assert all(f is None or len(f) <= jaccard.FAR for f in fars)
        rows.append(((len(x), fars[0]), (len(y), fars[1])))
        words = min(len(f or []) for f in fars)
        differ.append(int((sum(bin((a ^ b) & (2**64 - 1)).count("1") for a, b in zip(*(jaccard.parity(np.sort(s), words).tolist() for s in (x, y)), strict=True)))) if words else 0)
    kind = "struct<n:int,far:array<long>>"
    table = spark.createDataFrame(rows, f"x {kind}, y {kind}").coalesce(1)
    for percent in (50, 80, 99):
        got = [r.ok for r in table.selectExpr(f"{jaccard._far_signed(percent)} AS ok").collect()]
        least = [-(-percent * (x[0] + y[0]) // (100 + percent)) for x, y in rows]
        assert got == [d <= x[0] + y[0] - 2 * n for d, (x, y), n in zip(differ, rows, least, strict=True)]


def test_encoder_looks_a_word_up_once_for_many_texts():
    class Counting(dict):
        looked = 0

        def __getitem__(self, key):
            Counting.looked += 1
            return dict.__getitem__(self, key)

    for name, keeps in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        enc = tokens.tokenizer_encoder(public_tokenizers.path(name), keeps)
        texts = ["the cart was full"] * 50
        wanted = enc.encode(texts)
        enc.kept, Counting.looked = Counting(enc.kept), 0
        assert enc.encode(texts) == wanted and Counting.looked <= 5
        enc.kept = dict(enc.kept)


def test_words_with_signs_or_accents_ask_little_of_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    enc = tokens.tokenizer_encoder(path, False)
    texts = ["Größe Größe### größe*** größe,*** ÉTÉ été&&& can't can't' x_ _x a(b) don'###", " ʼn### İ### ſ,* Σας### ΣΑΣ, µ* ª# e\u0301t\u0301* \u0338= =\u0338"]
    texts += [f"straße{sign}" for sign in tokens.SIGNS] + ["", " ", "###", None]
    plain = tokens.whole(Tokenizer.from_file(path))
    wanted = [plain([t], enc.dtype)[0] if t else b"" for t in texts]
    asked, ask = [], enc.encode_words
    enc.kept.clear()
    enc.encode_words = lambda words, dtype: asked.extend(words) or ask(words, dtype)
    try:
        assert enc.encode(texts) == wanted == enc.encode(pa.array(["cut off", *texts]).slice(1))
    finally:
        enc.encode_words = ask
    assert not [w for w in asked if w[:2].lower() in ("gr", "st") and not w.isalpha()] and asked.count("größe") == 1


def test_ids_of_a_batch_are_gathered_from_arrow():
    for name, keeps in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        path = public_tokenizers.path(name)
        enc = tokens.tokenizer_encoder(path, keeps)
        texts = pa.array(["the cart was full", None, "", "two  spaces", "line\nline", " led", "the cart", "end\n", "x" * 50 + " y"] * 40)
        plain = tokens.whole(Tokenizer.from_file(path))
        wanted = [plain([t], enc.dtype)[0] if t else b"" for t in texts.to_pylist()]
        assert enc.encode(texts) == wanted == list(enc.encode_column(texts, 7))


def test_finder_finds_what_features_say_and_scores_without_keys(monkeypatch):
    names = sorted({f for w in WORDS[::2] for f in toxicity.features_of(w)})
    vocabulary = {f: i for i, f in enumerate(names)}
    text = " ".join(WORDS)
    wanted = {vocabulary[f] for w in WORDS for f in toxicity.features_of(w) if f in vocabulary}
    keyed = toxicity.Finder(vocabulary)
    assert keyed.look(text)[0] == wanted == keyed.look(text)[0]
    assert keyed.copy_key(set(WORDS)) == keyed.copy_key(set(reversed(WORDS)))

    def unasked(word):
        raise AssertionError("scores need no codes of words")

    monkeypatch.setattr(toxicity, "_code", unasked)
    model = toxicity.Model({f: 1.0 for f in names}, 0.0)
    assert model.scores([text, None])[1] == 0.5 < model.scores([text])[0]
