import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from spanloom.llm import exact, huffman, jaccard, packing, spm, tokens
from spanloom.llm.registry import queries

from .conftest import CLASHES, sentencepiece_model

WHITE = " \t\n\x0b\x0c\r"
WORDS = "the of and idiot scum thion ereat onsth blea ingth ndand hehe tion er re on".split()


def some_texts(seed, n, words=(0, 60)):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(*words))) for _ in range(n)]
    for _ in range(n // 2):  # near copies
        t = rng.choice(texts).split(" ")
        t[rng.randrange(len(t))] = rng.choice(WORDS)
        texts.append(" ".join(t))
    return texts


ODD = [None, "", " ", "\n\t", "a", "A", "word", "x " * 3000, "é" * 5000, "a b c", "a  b c", "A B C", "same text here", "same text here"]


def brute_copies(rows):
    def norm(t):
        return "".join(c for c in (t or "") if c not in WHITE)

    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i))
    out = {}
    for key, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            out[i] = (keep, len(members), i == keep, hashlib.sha256(key.encode()).hexdigest())
    return out


def test_exact_against_brute_force(make_docs):
    texts = ODD + some_texts(1, 40) + ["y" * 2048 + "z" * 2048 + "q", "y" * 2048 + " z" + "z" * 2047 + "q", "y" * 2048 + "z" * 2049]
    docs = make_docs(texts, CLASHES)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact.find_copies(docs).collect()}
    assert got == brute_copies(list(enumerate(texts)))


def test_exact_tells_blocks_of_one_hash_apart(make_docs, monkeypatch):
    monkeypatch.setattr(exact, "block_hash", lambda block: F.length(block).cast("long"))
    texts = ["ab", "ba", "a b", "y" * 2048 + "z" * 2048, "z" * 2048 + "y" * 2048, "y" * 4096, "y" * 2048 + " z" + "z" * 2047, None]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact.find_copies(make_docs(texts)).collect()}
    assert got == brute_copies(list(enumerate(texts)))


def test_exact_repeats_null_ids_and_no_rows(make_docs):
    rows = exact.find_copies(make_docs([(1, "t"), (1, "t"), (None, "t"), (2, "u")])).collect()
    assert sum(r.kept for r in rows) == 2
    assert {(r.doc_id, r.keep_id, r.group_size) for r in rows} == {(1, 1, 3), (None, 1, 3), (2, 2, 1)}
    assert exact.find_copies(make_docs([])).count() == 0


def brute_classes(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        s = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
        sets[i] = s
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = find(a), find(b)
            top[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_jaccard_against_brute_force(make_docs, size, percent):
    texts = ODD + some_texts(size, 40, (0, 50)) + [("of the and blea " * 20) + w for w in WORDS]
    docs = make_docs(texts, CLASHES)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_classes(docs, size, percent).collect()}
    assert got == brute_classes(list(enumerate(texts)), size, percent)


def test_jaccard_of_crowds(make_docs):
    base = [f"w{i}" for i in range(60)]
    rng = random.Random(4)
    texts = []
    for _ in range(60):
        t = list(base)
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(60)] = rng.choice(WORDS)
        texts.append(" ".join(t))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_classes(make_docs(texts), 3, 90).collect()}
    assert got == brute_classes(list(enumerate(texts)), 3, 90)


def test_jaccard_null_ids_and_no_rows(make_docs):
    rows = jaccard.link_classes(make_docs([(None, "a b c d"), (5, "a b c d"), (5, "a b c d")]), 3, 90).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in rows) == [(False, 5), (False, 5), (True, None)]
    assert jaccard.link_classes(make_docs([]), 3, 90).count() == 0


@pytest.mark.parametrize(("name", "spaced"), [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_pieces_give_the_tokenizers_ids(name, spaced):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    enc = tokens.tokenizer_encoder(public_tokenizers.path(name), spaced)
    rng = random.Random(7)
    parts = ["a", "Bc", " ", "  ", "\n", "\t", ".", ",", "!?", "'s", "'LL", "é", "Σ", "İ", "क़", "ć", "1", "１", "　", "가", "😀", "\x00", "\x01", "<|endoftext|>", "​"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)] + ["x" * 100_000, ""]
    for text, packed, e in zip(texts, enc.encode(texts), t.encode_batch(texts, add_special_tokens=False), strict=True):
        assert enc.ids(packed).tolist() == e.ids, repr(text)
    assert enc.encode([None]) == [b""]


def test_sentencepiece_parity():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, library = spm.SentencePieces(path, 1), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(8)
    parts = ["a", "Bc", " ", "  ", "\n", ".", "é", "Σ", "1", "가", "😀", "▁", "<s>", "​", "the", "ing"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["", "x" * 5000]
    ids = sp.encode(texts)
    assert [i.tolist() for i in ids] == library.encode(texts)
    assert all(sp.decode(i) == t for i, t in zip(ids, texts, strict=True) if "▁" not in t)
    assert sp.encode([None])[0].tolist() == []
    assert sp.model.kind == spm.BPE and sp.model.byte_fallback and len(sp.model.pieces) == 32000


SP_PARTS = ["a", "Bc", " ", "  ", "\n", "\t", ".", "é", "Σ", "1", "가", "😀", "▁", "<s>", "</s>", "<unk>", "<0x41>", "\u200b", "the", "ing", "①", "\u3000", "[SEP]", "the quick"]


@pytest.mark.parametrize("symbols", [(), ("[SEP]", "thequ")])
@pytest.mark.parametrize("mapped", [False, True])
@pytest.mark.parametrize(("prefix", "squeeze"), [(True, True), (False, False)])
@pytest.mark.parametrize(("kind", "byte_fallback"), [(spm.UNIGRAM, True), (spm.UNIGRAM, False), (spm.BPE, True)])
def test_sentencepiece_parity_of_other_models(tmp_path, kind, byte_fallback, prefix, squeeze, mapped, symbols):
    import sentencepiece

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        known = spm.parse(f.read()).pieces
    charsmap = b""
    if mapped:
        raw = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
        charsmap = next(v for n, v in spm._fields(next(v for n, v in spm._fields(raw) if n == 3)) if n == 2)
    rng = random.Random(11)
    own = [(p, 0.0, spm.USER) for p in symbols]
    if kind == spm.BPE:
        pieces = [*known[:3], *own, *known[3:]]
    else:
        normal = [p for p, _, k in known if k == spm.NORMAL][:4000]
        texts = [(p, -2.0 - 0.001 * i - rng.random(), spm.UNUSED if i % 50 == 7 else spm.NORMAL) for i, p in enumerate(normal)]
        pieces = [*known[:3], *own, *([p for p in known if p[2] == spm.BYTE] if byte_fallback else []), *texts]
    path = str(tmp_path / "m.model")
    with open(path, "wb") as f:
        f.write(sentencepiece_model(pieces, kind, byte_fallback, charsmap, prefix, squeeze))
    sp, library = spm.SentencePieces(path, 1), sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["".join(rng.choice(SP_PARTS) for _ in range(rng.randint(0, 25))) for _ in range(400)] + ["", " ", "\t", "▁", "x" * 3000]
    assert [i.tolist() for i in sp.encode(texts)] == library.encode(texts)


def test_sentencepiece_refuses_what_it_does_not_know():
    pieces = [("<unk>", 0.0, spm.UNKNOWN), ("a", -1.0, spm.NORMAL), ("b", -2.0, spm.UNUSED)]
    with pytest.raises(ValueError, match="in front"):
        spm.parse(sentencepiece_model(pieces, spm.UNIGRAM, False, suffix=True))
    with pytest.raises(ValueError, match="unused"):
        spm.parse(sentencepiece_model(pieces, spm.BPE, False))
    with pytest.raises(ValueError, match="unigram and BPE"):
        spm.parse(sentencepiece_model(pieces[:2], 3, False))


def test_sentencepiece_query(make_docs):
    rows = spm.verify_documents(make_docs(ODD, ("ids",)), public_tokenizers.path("piece_bpe_32k.model"), 1).collect()
    assert len(rows) == len(ODD) and all(r.same_ids and r.restored for r in rows)
    rows = spm.verify_documents(make_docs([(None, "a b"), (1, "a b"), (1, "a b")]), public_tokenizers.path("piece_bpe_32k.model"), 1).collect()
    assert sorted(r.doc_id is None for r in rows) == [False, False, True] and len({r.ids_crc32 for r in rows}) == 1
    assert spm.encode_documents(make_docs([]), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def optimum(sizes, capacity):
    best = {0: (1, 0)}
    for mask in range(1, 1 << len(sizes)):
        options = []
        for i, s in enumerate(sizes):
            if mask >> i & 1:
                k, used = best[mask ^ (1 << i)]
                options.append((k, used + s) if used + s <= capacity else (k + 1, s))
        best[mask] = min(options)
    return best[(1 << len(sizes)) - 1][0] if sizes else 0


def places(plan):
    out = {}
    for size, lo, hi, first, copies, base in plan.rows:
        for r in range(hi - lo):
            out.setdefault(first + r // copies, []).append((base + r % copies * size, size))
    return out


def test_packing_is_valid_and_the_reduction_optimal():
    rng = random.Random(9)
    for _ in range(300):
        capacity = rng.randint(4, 40)
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 8))]
        counts = {s: sizes.count(s) for s in sizes}
        plan = packing.make_plan(counts, capacity)
        found = places(plan)
        assert sorted(s for items in found.values() for _, s in items) == sorted(sizes)
        for items in found.values():
            at = 0
            for offset, size in sorted(items):
                assert offset == at
                at += size
            assert at <= capacity
        stock, fixed = packing._Stock(counts), packing.Plan(capacity)
        packing.reduce_instance(stock, fixed)
        rest = [s for s, n in stock.counts.items() for _ in range(n)]
        assert fixed.sequences + optimum(rest, capacity) == optimum(sizes, capacity)
        assert plan.sequences <= optimum(sizes, capacity) + 1


def test_packing_plan_does_not_grow_with_the_rows(spark):
    million = 10**6
    for counts, sequences in (
        ({1024: 300_000}, 150_000), ({700: 300_000, 600: 150_000}, 150_000), ({682: 300_000}, 100_000),
        ({1024: 3 * million}, 3 * million // 2), ({1000: million, 1020: million}, million),
        ({1024: 300_000, 3: million}, 150_000 + -(-million // 682)),
    ):
        plan = packing.make_plan(counts, 2048)
        assert plan.sequences == sequences and len(plan.rows) <= 2 * len(counts)
    rng = np.random.default_rng(1)
    for scale in (1, 1000):
        sizes = np.minimum(2048, rng.lognormal(5.5, 1.2, 300_000).astype(int) + 1)
        counts = {int(s): int(n) * scale for s, n in zip(*np.unique(sizes, return_counts=True), strict=True)}
        plan = packing.make_plan(counts, 2048)
        assert len(plan.rows) < 16 * len(counts) and plan.sequences <= 1.001 * packing.lower_bound(counts, 2048) + 1
    items = spark.range(300_000).selectExpr("id AS doc_id", "0 AS piece", "1024L AS length", "id AS ids_crc32")
    placed = packing.pack(items, 2048).groupBy("sequence_id").agg(F.collect_set("offset").alias("at"), F.count("*").alias("n"))
    assert placed.where("n = 2 and array_sort(at) = array(0L, 1024L)").count() == placed.count() == 150_000


def test_packing_documents(make_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    texts = [*ODD, *some_texts(2, 20)]
    rows = packing.pack_documents(make_docs([*enumerate(texts), (None, "x y"), (1, "z")], CLASHES), path, 0, 64).collect()
    assert sum(r.doc_id is None for r in rows) == 1 and len([r for r in rows if r.doc_id == 1]) == 2
    rows = [r for r in rows if r.doc_id is not None and r.doc_id != 1]
    t = Tokenizer.from_file(path)
    for r in rows:  # each piece's ids are those of the tokenizers library
        ids = [*t.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0][r.start : r.start + r.length]
        assert r.length == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    rows = packing.pack_documents(make_docs(texts, CLASHES[:4]), path, 0, 64).collect()
    sequences, docs = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for items in sequences.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 64
    for found in docs.values():
        found.sort()
        assert [p for p, _, _ in found] == list(range(len(found)))
        assert all(length == 64 for _, _, length in found[1:])
    assert packing.pack_documents(make_docs([]), path, 0, 64).count() == 0


def test_huffman_codes():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 50, 5000):
        counts = np.zeros(6000, dtype=np.int64)
        counts[rng.choice(6000, n, replace=False)] = (rng.pareto(0.7, n) * 5 + 1).astype(np.int64)
        lengths = huffman.code_lengths(counts)
        used = lengths[counts > 0].astype(int)
        assert used.min() >= 1 and used.max() <= huffman.TABLE_BITS and (lengths[counts == 0] == 0).all()
        assert (2.0 ** -used).sum() <= 1 + 1e-12
        ids = rng.choice(np.flatnonzero(counts), 3000).astype(np.int64)
        code = huffman.Code(lengths)
        for k in (0, 1, 511, 512, 513, 3000):
            payload, checks = code.encode(ids[:k])
            assert len(checks) == -(-k // huffman.BLOCK)
            assert (code.decode(payload, checks, k) == ids[:k]).all()
    fib = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610, 987, 1597, 2584, 4181, 6765, 10946])
    assert huffman.code_lengths(fib).max() == huffman.TABLE_BITS


def test_huffman_codes_of_many_ids():
    rng = np.random.default_rng(4)
    counts = (rng.pareto(0.5, 70_000) + 1).astype(np.int64)
    lengths = huffman.code_lengths(counts)
    assert 16 < lengths.max() <= huffman.longest_code(70_000) and (2.0 ** -lengths.astype(int)).sum() <= 1 + 1e-12
    code = huffman.Code(lengths)
    ids = rng.permutation(np.concatenate([np.arange(70_000), rng.choice(70_000, 30_000, p=counts / counts.sum())]))
    payload, checks = code.encode(ids)
    assert (code.decode(payload, checks, len(ids)) == ids).all()


def test_huffman_files_stay_under_a_path(spark, make_docs, tmp_path):
    path, at = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "ids")
    texts = [*ODD, *some_texts(6, 30)]
    made = huffman.store_documents(make_docs([*enumerate(texts), (None, "x"), (3, "x")]), path, False, 2, at)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    digest = lambda files: sorted(map(str, huffman.read_documents(*files, huffman.crc_digest, schema).collect()))
    assert digest(made) == digest(huffman.open_files(spark, at)) and len(digest(made)) == len(texts) + 2


def test_huffman_segments_hold_whole_documents(make_docs, monkeypatch):
    monkeypatch.setattr(huffman, "SEGMENT_IDS", 40)
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = some_texts(7, 60)
    book, segments = huffman.store_documents(make_docs(texts), path, False, 2)
    found = huffman.read_documents(book, segments, huffman.crc_digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
    rows = sorted(tuple(r) for r in found.collect())
    assert [r[0] for r in rows] == list(range(len(texts)))
    assert all(a[1] + a[2] == b[1] for a, b in itertools.pairwise(rows))


def test_huffman_files(make_docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [*ODD, *some_texts(5, 30)]
    order = list(range(len(texts)))
    random.Random(2).shuffle(order)
    docs = make_docs([(i, texts[i]) for i in order], CLASHES)
    book, segments = huffman.store_documents(docs, path, False, 2)
    got = huffman.read_documents(book, segments, huffman.crc_digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
    from tokenizers import Tokenizer

    t, at, expected = Tokenizer.from_file(path), 0, []
    for i, text in enumerate(texts):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((i, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in got.collect()) == expected
    book, segments = huffman.store_documents(make_docs([]), path, False, 2)
    assert huffman.read_documents(book, segments, huffman.crc_digest, "doc_id long, start long, n_tokens long, ids_crc32 long").count() == 0


def test_queries_have_the_contracts_columns(spark, sf_dir):
    columns = {
        "op1": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars", "op2": "page_id host path rule verdict",
        "op3": "doc_id n_shingles component_id", "op6": "doc_id keep_id group_size kept text_sha256",
        "op7": "doc_id start n_tokens ids_crc32", "op8": "vec_id n_links component_id kept",
        "op10": "doc_id piece start length ids_crc32 sequence_id offset",
        "op11": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256", "op12": "doc_id size source_size target taken",
        "op13": "doc_id leaf subroot root proof_sha256 folded_root verified",
    }
    made = queries()
    assert len(made) == 13
    for op, names in columns.items():
        (name,) = [n for n in made if n.startswith(op + "_")]
        assert set(names.split()) <= set(made[name](spark, sf_dir).columns)
