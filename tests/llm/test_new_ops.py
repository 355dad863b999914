"""Turn repair, mixing and the Merkle manifest against plain versions."""

import hashlib
import random
import zlib
from fractions import Fraction
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from spanloom.llm import merkle, mixing, q11_repair, q13_merkle, repair

TURNS = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def cheapest(turns):
    """(cost, audit, lines) of the best of all edits; turns are (role, text, fault)."""
    @lru_cache(None)
    def rest(i, state, inserted):
        # states: 0 nothing yet, 1 after s, 2 after u, 3 after a
        found = [(0, "", ())] if i == len(turns) and state in (0, 3) else []

        def step(cost, letter, line, then):
            if then is not None:
                c, audit, lines = then
                found.append((cost + c, letter + audit, ((line,) if line is not None else ()) + lines))

        if inserted < 3:
            if state != 2:
                step(5, "I", "user:", rest(i, 2, inserted + 1))
            else:
                step(5, "I", "assistant:", rest(i, 3, inserted + 1))
        if i < len(turns):
            role, text, fault = turns[i]
            step(2, "D", None, rest(i + 1, state, 0))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
                if (state, role[:1]) in after:
                    step(extra, "K", f"{role}:{text}", rest(i + 1, after[state, role[:1]], 0))
                new = "assistant" if state == 2 else "user"
                step(1 + extra, "R", f"{new}:{text}", rest(i + 1, after[state, new[0]], 0))
        return min(found) if found else None

    for i in range(len(turns), 0, -1):  # so that no recursion is deep
        for state in range(4):
            rest(i, state, 0)
    return rest(0, 0, 0)


def plain_digest(rows):
    """conv_id -> the digest columns."""
    out = {}
    hurt = damaged(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in hurt if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        known, turns = set(), []
        for _, role, text in mine:
            body = text.rstrip(WHITE)
            fault = "blank" if not body else "duplicate" if (role, text) in known else "truncated" if body[-1] not in ".!?" else ""
            known.add((role, text))
            turns.append((role, text, fault))
        numbers = [t for t, _, _ in mine if t is not None]
        initials = [r[:1] for r, _, _ in turns]
        cost, audit, lines = cheapest(tuple(turns))
        count = lambda f: sum(t[2] == f for t in turns)  # noqa: B023, E731
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, count("blank"), count("duplicate"), count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def random_turns(rng, convs, most):
    rows = []
    for conv in convs:
        for turn in range(rng.randrange(most + 1)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "ä"])
            text = rng.choice(["One.", "Two!", "cut", "Yes? ", " \n", "", None, "x.y", "é.\x0b", "One.", "a:b.", "line\nbreak."])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 1, None]), role, text))
    return rows


def by_conv(df):
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r.conv_id: tuple(r[c] for c in columns) for r in df.collect()}


def test_repair_is_the_cheapest_of_all_edits(spark):
    rng = random.Random(5)
    rows = random_turns(rng, [*range(300), None], 7) + random_turns(rng, range(300, 320), 60)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, TURNS).withColumn("at", F.lit(1)).withColumn("part", F.lit("x")).withColumn("fault", F.lit(None))
    got = by_conv(q11_repair.damage_and_repair(df))
    assert got == plain_digest(rows)
    assert q11_repair.damage_and_repair(df.limit(0)).count() == 0


def test_repair_of_a_conversation_over_many_partitions(spark):
    rng = random.Random(6)
    rows = [(7 if rng.random() < 0.6 else rng.randrange(20), t, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["One.", f"{t}.", f"{t}?", "cut"])) for t in range(900)]
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, TURNS)
        edits = repair.plan_edits(df)
        assert edits.where("conv_id = 7").select(F.shiftright("at", 33)).distinct().count() > 10
        hurt = q11_repair.damage_and_repair(df)
        got = by_conv(hurt)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert got == plain_digest(rows)


def test_repaired_turns_read_as_they_should(spark):
    rows = random_turns(random.Random(8), range(60), 9)
    edits = repair.plan_edits(spark.createDataFrame(rows, TURNS))
    turns = repair.repaired_turns(edits).orderBy("conv_id", "at", "slot").collect()
    digests = by_conv(repair.digest(edits))
    for conv, found in digests.items():
        lines = [f"{t.role}:{t.text}" for t in turns if t.conv_id == conv]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == found[-1]
        roles = "".join(line[0] for line in lines)
        assert roles.removeprefix("s") == "ua" * (len(roles.removeprefix("s")) // 2) and roles != "s"


def test_parts_of_a_conversation_join_to_its_best_repair():
    rng = random.Random(9)
    for _ in range(300):
        turns = [(rng.choice("suax"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(1, 14))]
        closing = [5 * len(repair.CLOSING[q]) for q in range(4)]
        cost, path = repair.best_paths(turns, closing)(repair.NONE)
        cuts = sorted({0, len(turns), *(rng.randrange(len(turns) + 1) for _ in range(3))})
        parts = [turns[a:b] for a, b in zip(cuts, cuts[1:])]
        audit, total = "", 0
        for part, (p, q) in zip(parts, repair.join_parts([repair.sum_up(part) for part in parts])):
            own, found = repair.best_paths(part, [0 if r == q else repair.NEVER for r in range(4)])(p)
            audit, total = audit + repair.audit_of(len(part), p, found), total + own
        assert (total + closing[q], audit) == (cost, repair.audit_of(len(turns), repair.NONE, path))


def sainte_lague(seats, weights, most):
    quota = [0] * len(weights)
    for _ in range(seats):
        open_ = [i for i in range(len(weights)) if quota[i] < most[i]]
        best = max(open_, key=lambda i: (Fraction(weights[i], 2 * quota[i] + 1), -i))
        quota[best] += 1
    return quota


def test_apportionment_takes_the_highest_quotients(spark):
    rng = random.Random(3)
    rows, expected = [], {}
    for group in range(25):
        n, seats = rng.randrange(1, 8), rng.randrange(0, 60)
        weights = [rng.choice([1, 2, 3, 50, rng.randrange(1, 1000)]) for _ in range(n)]
        most = [-(-w * seats // sum(weights)) + rng.randrange(2) for w in weights]
        rows += [(group, i, seats, w, m) for i, (w, m) in enumerate(zip(weights, most))]
        expected.update({(group, i): q for i, q in enumerate(sainte_lague(seats, weights, most))})
    df = spark.createDataFrame(rows, "g long, i long, seats long, w long, m long")
    got = mixing.apportion(df, ["g"], F.col("seats"), F.col("w"), F.col("m"), [F.col("i")])
    assert {(r.g, r.i): r.quota for r in got.collect()} == expected


def plain_targets(sizes, percent=150, weights=(5, 2, 1)):
    """Shares by weight; what is above a limit is shared again until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, left = set(), Fraction(percent * sum(sizes.values()), 100)
    while True:
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return {**share, **{s: Fraction(2 * sizes[s]) for s in full}}
        full |= set(over)
        left -= sum(2 * sizes[s] for s in over)


DOCS = "doc_id long, text string, source string"


def documents(rng, n, sources):
    rows = []
    for i in range(n):
        words = rng.choice([0, 1, 5, 40, 200, rng.randrange(3000) if rng.random() < 0.1 else 3])
        rows.append((i, rng.choice([" ", "\n", "\x0b "]).join(["wörd"] * words), rng.choice(sources)))
    return rows


@pytest.mark.parametrize("shard", [mixing.SHARD_WORDS, 700])
def test_mix_meets_targets(spark, monkeypatch, shard):
    monkeypatch.setattr(mixing, "SHARD_WORDS", shard)
    rng = random.Random(4)
    rows = documents(rng, 900, ["a", "a", "a", "a", "a", "b", "c", "Z", "é", None, "tiny"]) + [(2000, None, "empty"), (None, "x y", "b"), (None, "x y", "b"), (3, "again", "c")]
    df = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("x")).withColumn("shard", F.lit(1))
    result = lambda df: (m := mixing.mix(df)).select("*", mixing.words_taken(m["spans"]).alias("taken"))
    got = result(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    target = plain_targets(sizes)
    named = {i: s for i, t, s in rows if i is not None and i != 3}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        if r.doc_id in named:
            source = named[r.doc_id]
            assert r.source_size == sizes[source] and abs(r.target - target[source]) < 1e-6 * max(1, target[source])
    by_pair = {(r.source_size, round(r.target, 6)): 0 for r in got}
    for r in got:
        by_pair[r.source_size, round(r.target, 6)] += r.taken
    for (_, goal), n in by_pair.items():
        assert abs(n - goal) <= 2 * mixing.BLOCK_WORDS * (1 if shard > 700 else max(sizes.values()) // shard + 2), (n, goal)
    again = result(df.repartition(7)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
    assert sorted(got, key=key) == sorted(again, key=key)
    assert mixing.mix(df.limit(0)).count() == 0
    assert {r.taken for r in result(df.where("source = 'empty'")).collect()} == {0}
    texts = {r.doc_id: r.t for r in df.where("doc_id < 900 and doc_id <> 3").join(mixing.mix(df).select("doc_id", "spans"), "doc_id").select("doc_id", mixing.text_taken(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert {i: len(t.split()) for i, t in texts.items()} == {r.doc_id: r.taken for r in got if r.doc_id in texts}
    assert all(0 <= s.start and s.start + s.length <= r.size and s.length > 0 for r in got for s in r.spans)


def test_mix_equals_its_sql(spark, tmp_path, monkeypatch):
    import duckdb

    from spanloom.llm import q12_mixing

    rng = random.Random(12)
    rows = documents(rng, 700, ["a", "a", "a", "b", "c", "Z", "é", None, "tiny"]) + [(2000, None, "empty"), (None, "x y", "b"), (4, "again", "c")]
    df = spark.createDataFrame(rows, DOCS)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = sorted(map(str, map(tuple, q12_mixing.op12_mixing(spark, str(tmp_path)).select("doc_id", "size", "source_size", "taken").collect())))
    sql = q12_mixing.ORACLES["op12_mixing"]
    want = con.sql(f"SELECT doc_id, size, source_size, taken FROM ({sql})").fetchall()
    assert got == sorted(map(str, want))
    monkeypatch.setattr(mixing, "SHARD_WORDS", 900)  # many shards
    got = sorted(map(str, map(tuple, q12_mixing.op12_mixing(spark, str(tmp_path)).select("doc_id", "size", "source_size", "taken").collect())))
    want = con.sql(f"SELECT doc_id, size, source_size, taken FROM ({sql.replace(str(1 << 18), '900')})").fetchall()
    assert got == sorted(map(str, want))


def test_targets_stop_at_limits(spark):
    rng = random.Random(10)
    for _ in range(4):
        sizes = {f"s{i}" if i else None: rng.choice([0, 1, 10, 1000, rng.randrange(10**6)]) for i in range(rng.randrange(1, 12))}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        assert got == pytest.approx({s: float(t) for s, t in plain_targets(sizes).items()})


def plain_manifest(rows):
    """The manifest by lists, one source at a time; rows are (doc_id, text, lang, source, n_chars)."""
    h = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: h(*map(field, (r[0], r[3], r[2], r[4], text)))
    sources = {}
    for r in rows:
        sources.setdefault(r[3], []).append((r, leaf(r, r[1])))

    def climb(nodes):
        """Root, and the siblings of every leaf as (left, right) lists level by level."""
        paths, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            above, merged = [], []
            for i in range(0, len(nodes), 3):
                run = nodes[i : i + 3]
                for j in range(len(run)):
                    for x in groups[i + j]:
                        paths[x].append((run[:j], run[j + 1 :]))
                above.append(h(*run))
                merged.append(sum(groups[i : i + 3], []))
            nodes, groups = above, merged
        return nodes[0] if nodes else None, paths

    trees = {}
    for source, found in sources.items():
        found.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[source] = climb([leaf_ for _, leaf_ in found])
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    root, upper = climb([trees[s][0] for s in order])
    out = []
    for at, source in enumerate(order):
        for (r, own), path in zip(sources[source], trees[source][1]):
            path = path + upper[at]
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(r, text)
            for left, right in path:
                node = h(*left, node, *right)
            proof = h(*(s for left, right in path for s in left + right))
            out.append((r[0], own, trees[source][0], root, proof, node, node == root))
    return out


@pytest.mark.parametrize("least", [1, merkle.LEAST_HEIGHT])
@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 90, 400])
def test_manifest(spark, monkeypatch, least, n):
    monkeypatch.setattr(merkle, "LEAST_HEIGHT", least)
    monkeypatch.setattr(merkle, "MOST_BLOCKS", 20)
    rng = random.Random(n)
    sources = ["a", "a", "a", "a", "b", "é", "z", None, "", "one"]
    rows = [(rng.choice([i, i, i, None, 3]), rng.choice(["t\nx", "äö", "", None, "long " * 50 + "\n", f"{i}"]), rng.choice(["en", None]), rng.choice(sources), rng.choice([1, -5, None])) for i in range(n)]
    rows += rows[:2]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df = df.select("*", F.lit(1).alias("p"), F.lit("x").alias("leaf"), F.lit(2).alias("n"), F.lit(3).alias("block"))
    got = [tuple(r) for r in merkle.prove(df, q13_merkle.tampered()).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
    key = lambda r: tuple((v is None, v or 0) if i == 0 else v for i, v in enumerate(r))
    assert sorted(got, key=key) == sorted(plain_manifest(rows), key=key)


def test_paths_of_a_manifest_verify_rows_by_themselves(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEAST_HEIGHT", 1)
    rows = [(i, f"text\n{i}", "en", "s" if i % 3 else None, i) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    made = merkle.prove(df, F.col("text"), paths=True)
    root = made.first().root
    assert made.where("not verified").isEmpty()
    held = df.join(made.select("doc_id", "path"), "doc_id")
    assert merkle.verify(held, root).where("not verified").isEmpty()
    changed = merkle.verify(held.withColumn("text", F.when(F.col("doc_id") == 7, "other").otherwise(F.col("text"))), root)
    assert [r.doc_id for r in changed.where("not verified").collect()] == [7]
