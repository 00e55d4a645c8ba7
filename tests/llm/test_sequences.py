"""Alignment, the prefix trie and packing, against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sitetext.llm import alignment, packing, prefix_trie

DOC_SCHEMA = (
    "doc_id bigint, text string, row bigint, pair string, n int, rare string, ids string, "
    "start string, key string"
)
TALK_SCHEMA = (
    "conv_id bigint, turn bigint, role string, text string, key string, seq string, words int, "
    "block string, depth string"
)


def odd_texts() -> list[str | None]:
    rng = random.Random(7)
    marks = [*"abcdeé.,'!? 0123", "\n", "\t", " ", " ", "the", " the", "'s", " ", " ", "日本", "🙂", "İ", "ﬁ"]
    mixed = ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    return [
        None, "", " ", "  ", "\n", "\n\n", "a", " a", "a ", "A b. C d! E f? g", "a\nb\n\nc \n d", "x  y   z ",
        "▁ piece ▁mark", "<|endoftext|> and <|startoftext|> </s> <unk> <0x41>", "a<|startoftext|>b.c",
        "\x00nul \x01\x7f\x85 x", "z" * 9000, "naïve ÉCOLE über ΣΑΣ", "word " * 3000, "a b " * 1500 + ".",
        "Some words end. Others do not! " * 400, "same text", "same text", *mixed,
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, "p", 2, "r", "i", "s", "k") for i, t in enumerate(odd_texts())]
    rows += [(None, "no id here. And more.", None, None, None, None, None, None, None), rows[9], rows[9]]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3).cache()


# Alignment


def plain_alignment(texts: list[str | None]) -> list[tuple]:
    words = alignment.vocabularies(*alignment.default_paths())

    def string(of, i):
        return of.data[of.starts[i] : of.starts[i] + of.sizes[i]].tobytes()

    parts = []
    for text in texts:
        a = words._a.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = words._b.encode(text) if text else []
        whole = f" {text}".encode() if text else b""
        sides = [[string(of, i) for i in ids] for ids, of in ((a, words.a), (b, words.b))]
        if any(b"".join(side) != whole for side in sides):
            a, b, sides = [], [], [[], []]
        ends = [np.cumsum([len(x) for x in side]).tolist() if side else [] for side in sides]
        links, groups = [], []
        i = j = 0
        group = ([], [])
        while i < len(a):
            links.append((a[i], b[j]))
            x, y = ends[0][i], ends[1][j]
            if x <= y:
                group[0].append(a[i])
                i += 1
            if y <= x:
                group[1].append(b[j])
                j += 1
            if x == y:
                groups.append("|".join(",".join(map(str, g)) for g in group))
                group = ([], [])
        parts.append((len(a), len(b), groups, links))
    counts = Counter(x for p in parts for x in p[3])
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (
            n_a, n_b, len(groups), len(links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
        )
        for n_a, n_b, groups, links in parts
    ]


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


ALIGNED = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


@pytest.mark.parametrize("broadcast_pairs", [500_000, 40, 0])
def test_alignment_equals_a_merge_of_the_borders(docs, broadcast_pairs):
    rows = docs.collect()
    expected = plain_alignment([r.text for r in rows])
    found = alignment.aligned_tokens(docs, broadcast_pairs=broadcast_pairs)
    assert found.columns == ["doc_id", *ALIGNED]
    want = sorted(((r.doc_id, *e) for r, e in zip(rows, expected, strict=True)), key=str)
    assert rows_of(found, "doc_id", *ALIGNED) == want
    assert sum(w[1] == 0 for w in want) == 3  # null, empty, and a literal piece mark


def test_alignment_of_an_empty_table(docs):
    assert alignment.aligned_tokens(docs.where("doc_id < 0")).count() == 0


@pytest.mark.parametrize("lane", [1, 2, 7, 64])
def test_lanes_do_not_change_links(lane):
    rng = np.random.default_rng(3)
    ends = [np.unique(np.append(rng.integers(1, 400, 120), 400)) for _ in range(2)]
    both = [np.concatenate([e, e + 400]) for e in ends]
    first = np.array([0, len(ends[0])])
    a, b, cut_a, cut_b = alignment.lockstep(*both, first, lane)
    starts = [np.concatenate([[0], e[:-1]]) for e in both]
    overlap = (starts[0][:, None] < both[1]) & (both[0][:, None] > starts[1])
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == list(zip(*map(np.ndarray.tolist, np.nonzero(overlap)), strict=True))
    common = np.intersect1d(*both)
    assert both[0][cut_a].tolist() == both[1][cut_b].tolist() == common.tolist()


# Packing


def test_pieces_hold_the_ids_of_the_library(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.default_path())
    rows = docs.collect()
    want = Counter()
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [packing.END_ID]
        want[r.doc_id, tuple(ids)] += 1
    pieces = packing.packed_pieces(docs, run_tokens=3000, with_ids=True).collect()
    by_sequence = defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) > 0
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        by_sequence[p.sequence_id].append(p)
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == np.cumsum([0, *(p.length for p in parts)])[:-1].tolist()
        assert sum(p.length for p in parts) <= packing.WINDOW
    # In the order of sequences, pieces follow each other document by document.
    got, ids = Counter(), []
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.start == len(ids)
        ids += p.ids
        if len(ids) == p.doc_tokens:
            got[p.doc_id, tuple(ids)] += 1
            ids = []
    assert got == want and not ids


def test_little_padding(spark, docs):
    lengths = [
        sum(r.length for r in rows)
        for rows in _grouped(packing.packed_pieces(docs).collect(), "sequence_id").values()
    ]
    padding = sum(packing.WINDOW - n for n in lengths if n & (n - 1))
    assert padding <= 0.01 * sum(lengths)


def _grouped(rows, column):
    out = defaultdict(list)
    for r in rows:
        out[r[column]].append(r)
    return out


@pytest.mark.parametrize("seed", range(40))
def test_cuts_have_the_least_cost(seed):
    rng = np.random.default_rng(seed)
    window = int(rng.choice([1, 4, 16, 64]))
    doc_ends = np.unique(rng.integers(1, 300, 6))
    total = int(doc_ends[-1])
    sentences = np.unique(rng.integers(1, total + 1, rng.integers(1, 40)))
    places, costs = packing.candidates(doc_ends, sentences, window)
    assert np.diff(places).max() <= window
    least = [0.0] + [float("inf")] * (len(places) - 1)

    def cost(size):
        return packing.SEQUENCE_COST + (0 if size & (size - 1) == 0 else window - size)

    for j in range(1, len(places)):
        sizes = places[j] - places[:j]
        least[j] = costs[j] + min(
            least[i] + cost(int(s)) for i, s in enumerate(sizes) if s <= window
        )
    cuts = packing.best_cuts(places, costs, window)
    of_place = dict(zip(places.tolist(), costs.tolist(), strict=True))
    sizes = np.diff(np.concatenate([[0], cuts]))
    assert cuts[-1] == total and sizes.max() <= window
    assert sum(of_place[c] for c in cuts.tolist()) + sum(map(cost, sizes.tolist())) == least[-1]


def test_packing_edges(spark, docs):
    assert packing.packed_pieces(docs.where("doc_id < 0")).count() == 0
    [only] = packing.packed_pieces(docs.where("text IS NULL")).collect()
    assert (only.start, only.length, only.doc_tokens, only.offset) == (0, 1, 1, 0)
    with pytest.raises(ValueError):
        packing.packed_pieces(docs, window=100)


# The prefix trie


def talks() -> list[tuple]:
    rng = random.Random(3)
    out = []
    for c in [*range(0, 45), *range(200, 230), 1000, -3, -20]:
        turns = [("user", rng.choice("abc"))] if rng.random() < 0.9 else []
        turns += [(rng.choice(["user", "assistant", None]), rng.choice(["x y", "z", "", None])) for _ in range(rng.randrange(4))]
        out += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    # A long one, its copy, a beginning of it, and many copies of one conversation.
    long = [("user", f"turn {i} of many") for i in range(300)]
    for c, turns in ((500, long), (520, long), (540, long[:150])):
        out += [(c, i, *t) for i, t in enumerate(turns)]
    out += [(3000 + 20 * i, 0, "user", "hot start") for i in range(60)]
    out += [(c, None, "user", "before all") for c in (7, 8)]
    out += [(9, 1, "user", "again"), (9, 1, "user", "again"), (9, 1, "user", "tie")]
    out += [(None, 0, "user", "of nobody"), (None, None, None, None)]
    return [(*t, "k", "s", 1, "b", "d") for t in out]


def plain_trie(rows: list[tuple]) -> list[tuple]:
    def digest(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]

    by_conv = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            by_conv[c].append((turn is not None, turn or 0, digest(role, text), role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in by_conv.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
        ends[rebuilt[c]].append(c)
    children = Counter(p[:-1] for p in members if p)
    saved, leaves = Counter(), Counter()
    for p, of in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(of) - 1) * words
            leaves[p[:d]] += not children[p]
    return sorted(
        (
            (
                of[0], len(p), members[p[:-1]][0] if p else None, len(of), children[p], leaves[p],
                saved[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest(),
            )
            for p, of in members.items()
        ),
        key=str,
    )


@pytest.mark.parametrize("block_turns", [500_000, 400, 3])
def test_trie_equals_a_plain_one(spark, block_turns):
    rows = talks()
    table = spark.createDataFrame(rows, TALK_SCHEMA).repartition(3)
    sequences = prefix_trie.with_shared_beginnings(prefix_trie.turn_sequences(table))
    found = prefix_trie.prefix_trie(sequences, block_turns=block_turns)
    want = plain_trie(rows)
    assert rows_of(found, *found.columns) == want
    hot = max((w for w in want if w[1] == 1), key=lambda w: w[3])
    assert hot[3] > 10


def test_trie_of_no_and_of_turnless_conversations(spark):
    table = spark.createDataFrame(talks(), TALK_SCHEMA)
    none = prefix_trie.turn_sequences(table.where("conv_id < -100"))
    assert prefix_trie.prefix_trie(none).count() == 0
    # A conversation whose own only turn is replaced by that of an absent one has no turns.
    alone = next(c for c in range(10_001, 10_019) if zlib.crc32(str(c).encode()) % 4 == 1)
    rows = [(alone, 0, "user", "gone", "k", "s", 1, "b", "d")]
    table = spark.createDataFrame(rows, TALK_SCHEMA)
    [root] = prefix_trie.prefix_trie(
        prefix_trie.with_shared_beginnings(prefix_trie.turn_sequences(table))
    ).collect()
    digest = hashlib.sha256(str(alone).encode()).hexdigest()
    assert tuple(root) == (alone, 0, None, 1, 0, 1, 0, digest)


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
def test_range_minima(n):
    values = np.random.default_rng(n).integers(0, 5, n)
    table = prefix_trie.RangeMinima(values)
    first, last = np.triu_indices(n)
    assert table.least(first, last).tolist() == [values[a : b + 1].min() for a, b in zip(first, last, strict=True)]
    rows = np.repeat(np.arange(n + 1), 6)
    depths = np.tile(np.arange(6), n + 1)
    for r, d, a, b in zip(rows, depths, table.left_ends(rows, depths), table.right_ends(rows, depths), strict=True):
        left, right = r, r
        while left and values[left - 1] >= d:
            left -= 1
        while right < n and values[right] >= d:
            right += 1
        assert (a, b) == (left, right)
