"""Exact dedup, fill-in-middle and the prefix trie against brute force."""

import math
import random
import re
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from veritide.llm import bloom_dedup, fim, prefix_trie
from veritide.llm.common import settled

DOCS = "doc_id long, text string, sha string, place string, kept string"


# Exact dedup


def _same(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def _groups(rows):
    """(doc_id, keep_id, group_size, text_sha256) of each row, and how many rows of each text stay: one."""
    held = defaultdict(list)
    for doc_id, text, *_ in rows:
        held[_same(text)].append(doc_id)
    keep = {t: max(ids, key=lambda i: (i is not None, i)) for t, ids in held.items()}
    return sorted(
        ((i, keep[_same(t)], len(held[_same(t)]), sha256(_same(t).encode()).hexdigest()) for i, t, *_ in rows), key=repr
    )


def _dedup_rows():
    rows = [(i, f"Text {i % 900}", "a", "b", "c") for i in range(1500)]
    rows += [(None, None, None, None, None), (2000, "", "a", None, None), (2001, "ÀÉ", "x", "y", "z"), (2002, "àé", "x", "y", "z")]
    rows += [(3000, "word " * 60000, "a", "b", "c"), (3001, "WORD " * 60000, "a", "b", "c")]
    rows += [(4000, "row", "a", "b", "c")] * 3 + [(None, "ROW", "a", "b", "c")] * 2
    return rows + [(5000 + i, "Hot", "a", "b", "c") for i in range(800)]


@pytest.mark.parametrize("rows_per_segment,segments", [(4096, 8192), (64, 5)])
def test_exact_dedup(spark, monkeypatch, rows_per_segment, segments):
    monkeypatch.setattr(bloom_dedup, "ROWS_PER_SEGMENT", rows_per_segment)
    monkeypatch.setattr(bloom_dedup, "SEGMENTS_PER_SLICE", segments)
    rows = _dedup_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    found = bloom_dedup.verdicts(docs).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == _groups(rows)
    kept = [r for r in found if r.kept]
    assert Counter(r.text_sha256 for r in kept) == Counter({r.text_sha256: 1 for r in found})
    assert all(r.doc_id == r.keep_id for r in kept)
    stay = bloom_dedup.deduplicated(docs)
    assert stay.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in stay.collect()), key=repr) == sorted(
        ((r.keep_id, None) if r.keep_id is None else (r.keep_id, dict((a, b) for a, b, *_ in rows)[r.keep_id]) for r in kept), key=repr
    )


def test_dedup_of_an_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert bloom_dedup.verdicts(empty).count() == 0
    assert bloom_dedup.deduplicated(empty).columns == empty.columns


def test_few_single_rows_may_repeat_and_no_repeated_row_is_missed(spark):
    ids = spark.range(40_000, numPartitions=7)
    text = F.when(F.col("id") % 100 == 0, F.lit("copy")).otherwise(F.col("id").cast("string"))
    rows = settled(ids.select(bloom_dedup.digest(text).alias("sha"), (F.col("id") % 100 == 0).alias("repeated")))
    told = bloom_dedup._told_apart(rows, 40_000).groupBy("repeated").agg(F.count_if("possible").alias("n")).collect()
    found = {r.repeated: r.n for r in told}
    assert found[True] == 400
    assert found[False] < 0.01 * 39_600


# Fill-in-middle


def _brute_fim(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    drawn = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(drawn[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def _fim_texts():
    rng = random.Random(3)
    parts = ["foo", "Bar", " ", "é", "日", "1", "\n", "longword" * 40, "🙂", "<", "S>", "P>", "M", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 2500))) for _ in range(120)]
    shared = "".join(rng.choice(parts) for _ in range(3000))
    texts += [t + shared for t in texts[:20]]
    return texts + ["", None, "a" * 70000, "é" * 30000, " " * 20000, "x<P>y", "<M>", "<S", "word " * 50000, "a"]


@pytest.mark.parametrize("remembered,block", [(64 << 20, 4 << 20), (20_000, 1000)])
def test_fill_in_middle(spark, monkeypatch, remembered, block):
    monkeypatch.setattr(fim, "REMEMBERED", remembered)
    monkeypatch.setattr(fim, "BLOCK", block)
    rows = list(enumerate(_fim_texts(), -3)) + [(None, "null id and text"), (None, "null id and text")]
    docs = spark.createDataFrame([(i, t, "n", "f") for i, t in rows], "doc_id long, text string, n string, form string")
    made = fim.transformed(docs.repartition(3))
    assert made.columns == [*docs.columns, "fim"]
    expected = sorted(((i, *_brute_fim(i, t)) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, *r.fim) for r in made.collect()), key=repr) == expected
    found = fim.digests(docs).collect()
    shown = sorted(((r.doc_id, r.n, r.form, r.output_sha256, r.restored_sha256) for r in found), key=repr)
    digest = lambda t: sha256((t or "").encode()).hexdigest()
    texts = sorted(((i, *_brute_fim(i, t)[:2], digest(_brute_fim(i, t)[4]), digest(t)) for i, t in rows), key=repr)
    assert shown == texts


def test_fill_in_middle_names_and_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, FIM string")
    assert fim.transformed(docs).columns == ["doc_id", "text", "FIM", "fim_"]
    assert fim.transformed(docs).count() == 0
    assert fim.digests(docs).count() == 0


def test_chunks_are_where_the_content_is():
    rng = random.Random(5)
    shared = "".join(rng.choice("abcdefgh é") for _ in range(30_000))
    own = [set(), set()]
    for i, head in enumerate(("one head", "another head of other length " * 9)):
        data = (head + shared).encode()
        ends = [0, *fim.cuts(data)]
        assert ends[-1] == len(data)
        assert max(b - a for a, b in zip(ends, ends[1:])) <= fim.LONGEST
        own[i] = {data[a:b] for a, b in zip(ends, ends[1:])}
    assert len(own[0] & own[1]) > 0.8 * len(own[0])


def test_remembered_chunks_are_bounded():
    memory = fim.Chunks(50_000)
    for i in range(2000):
        memory.summary(b"%d " % i * 100)
    held = sum(len(c) for c in [*memory.newer, *memory.older])
    assert held < 60_000


# Prefix trie


def _brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            item = sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            turns[conv].append(((turn is not None, turn or 0, item), (role, text)))
    own = {c: [v for _, v in sorted(held)] for c, held in turns.items()}
    made = {}
    for c in own:
        h, base = crc32(str(c).encode()) % 9, c - int(math.fmod(c, 5))
        made[c] = own.get(base, [])[:h] + own[c][h:]
    members, children = defaultdict(list), defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[x] for x in below) if below else 1
        own_size = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        saved[path] = own_size + sum(saved[x] for x in below)
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(made[c]) == len(path)))
        parent = min(members[path[:-1]]) if path else None
        out.append(
            (min(convs), len(path), parent, len(convs), len(children.get(path, [])), leaves[path], saved[path], sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def _nodes(frame):
    return sorted((tuple(r) for r in prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.numbered(frame))).collect()), key=repr)


TURNS = "conv_id long, turn long, role string, text string"


def _conversations(seed):
    rng, rows = random.Random(seed), []
    for c in range(60):
        for t in range(rng.choice([0, 1, 3, 9, 12, 25])):
            text = rng.choice(["x", "x", "x", "y", None]) if t > 4 else "héllo"
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["u", "a", None]) if t < 3 else "u", text))
    rows += [(c, t, "u", "héllo") for c in range(100, 160) for t in range(9)]  # copies over many ranges
    rows += [(777, t % 50, "u", f"z{t % 3}") for t in range(200)]  # one long conversation
    return rows + [(None, 1, "a", "b"), (-7, 1, "a", "b"), (2**62, 1, "a", "b")] + [(779, None, None, None)] * 40


@pytest.mark.parametrize("seed,slab,few,ranges,batch", [(0, 3, 5, 7, 1000), (1, 2, 2, 3, 7), (2, 64, 2000, 100_000, 200_000)])
def test_prefix_trie(spark, monkeypatch, seed, slab, few, ranges, batch):
    for name, value in zip(("SLAB", "FEW_ROWS", "ROWS_PER_RANGE", "BATCH", "TURNS_PER_PART"), (slab, few, ranges, batch, 6)):
        monkeypatch.setattr(prefix_trie, name, value)
    rows = _conversations(seed)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS + ", item string, pos long").repartition(3)
    assert _nodes(frame) == _brute_trie(rows)


def test_prefix_trie_of_few_or_no_turns(spark):
    assert _nodes(spark.createDataFrame([], TURNS)) == []
    assert _nodes(spark.createDataFrame([(None, 1, "a", "b")], TURNS)) == []
    turnless = next(c for c in range(1, 99) if c % 5 and crc32(str(c).encode()) % 9 > 1)
    rows = [(turnless, 1, "a", "b")]  # its only turn would come from a conversation that is absent
    assert _nodes(spark.createDataFrame(rows, TURNS)) == _brute_trie(rows) == [
        (turnless, 0, None, 1, 0, 1, 0, sha256(str(turnless).encode()).hexdigest())
    ]


def test_sparse_table_extents():
    import numpy as np

    rng = np.random.default_rng(0)
    for size in (1, 2, 3, 64, 101):
        values = rng.integers(0, 6, size)
        values[0] = -1
        table = prefix_trie.Minima(values)
        start = np.repeat(np.arange(size), 6)
        least = np.tile(np.arange(6), size)
        right, left = table.extent_right(start, least), table.extent_left(start, least)
        for s, e, r, a in zip(start, least, right, left):
            assert all(values[s + 1 : r + 1] >= e) and (r == size - 1 or values[r + 1] < e)
            assert all(values[a + 1 : s + 1] >= e) and (a == 0 or values[a] < e)
        first = rng.integers(0, size, 50)
        last = np.maximum(first, rng.integers(0, size, 50))
        assert [values[a : z + 1].min() for a, z in zip(first, last)] == table.over(first, last).tolist()
