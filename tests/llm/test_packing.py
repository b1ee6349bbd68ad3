import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, piece string"


def checked(rows, capacity):
    """Every sequence is filled without gaps or overlaps."""
    content = defaultdict(list)
    for row in rows:
        content[row.sequence_id].append((row.offset, row.length))
    for places in content.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return content


def test_every_row_whole_and_placed_once(spark, sf_dir):
    tokenizer = Tokenizer.from_file(PATH)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = queries.op10_best_fit_packing(spark, sf_dir).collect()
    content = checked(rows, 1024)
    by_document = defaultdict(list)
    for row in rows:
        by_document[row.doc_id].append(row)
    assert len(by_document) == len(documents)
    total = 0
    for document in documents:
        ids = tokenizer.encode(document.text or "", add_special_tokens=False).ids + [2]
        own = sorted(by_document[document.doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == list(np.cumsum([0, *(r.length for r in own[:-1])]))
        assert sum(r.length for r in own) == len(ids)
        assert all(r.length == 1024 for r in own[1:])
        for r in own:
            part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
        total += len(ids)
    assert len(content) <= 1.01 * -(-total // 1024) + 1


def test_odd_texts(spark):
    special = "a <|endoftext|> b"
    rows = [(1, None, "x"), (1, None, "x"), (2, "", None), (None, "word " * 5000, "y"),
            (3, special, "z"), (3, special, "z"), (4, "é\x00  ", None)]
    out = packing.pack(spark.createDataFrame(rows, SCHEMA), PATH).collect()
    checked(out, 1024)
    sizes = Counter()
    for row in out:
        sizes[row.doc_id] += row.length
    ids = Tokenizer.from_file(PATH).encode(special, add_special_tokens=False).ids
    assert 50256 in ids
    assert sizes[1] == 2 and sizes[2] == 1 and sizes[3] == 2 * (len(ids) + 1)
    assert sizes[None] > 4 * 1024


def test_empty_table(spark):
    out = packing.pack(spark.createDataFrame([], SCHEMA), PATH)
    assert out.count() == 0 and out.columns[-1] == "offset"


def test_a_shared_length_is_numbered_in_groups(spark):
    rows = [(i, "same", "") for i in range(400)]
    out = packing.pack(spark.createDataFrame(rows, SCHEMA), PATH, 8, rows_per_group=7).collect()
    assert len(out) == 400
    content = checked(out, 8)
    assert len(content) == 100  # two tokens each


def volume(counts):
    return sum(k * n for k, n in counts.items())


def optimum(pieces, capacity):
    """Fewest sequences, by trying everything."""
    pieces = sorted(pieces, reverse=True)
    best = [len(pieces)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(pieces):
            best[0] = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= pieces[i] and rooms[j] not in rooms[:j]:
                go(i + 1, [*rooms[:j], rooms[j] - pieces[i], *rooms[j + 1 :]])
        go(i + 1, [*rooms, capacity - pieces[i]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(60))
def test_fixed_sets_never_cost_a_sequence(seed):
    pick = random.Random(seed)
    capacity = pick.choice([10, 20, 37])
    pieces = [pick.randint(1, capacity) for _ in range(pick.randint(1, 9))]
    fixed, rest = packing.reduce_by_dominance(Counter(pieces), capacity)
    placed = Counter()
    for pattern, n in fixed:
        assert sum(pattern) <= capacity
        for length in pattern:
            placed[length] += n
    assert placed + Counter(rest) == Counter(pieces)
    left = optimum(list(Counter(rest).elements()), capacity) if rest else 0
    assert sum(n for _, n in fixed) + left == optimum(pieces, capacity)


@pytest.mark.parametrize("seed", range(20))
def test_plan_uses_each_rank_once(seed):
    pick = random.Random(seed)
    counts = {pick.randint(1, 100): pick.randint(1, 500) for _ in range(40)}
    runs = packing.plan(counts, 100)
    ranks = defaultdict(list)
    rooms = Counter()
    for length, first, end, sequence, _ in runs:
        ranks[length] += range(first, end)
        for i in range(end - first):
            rooms[sequence + i] += length
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    assert max(rooms.values()) <= 100
    assert len(rooms) <= 1.25 * -(-volume(counts) // 100)


def test_equal_ids_from_both_libraries(sf_dir):
    import pyarrow.parquet as pq

    texts = pq.read_table(f"{sf_dir}/documents.parquet")["text"].to_pylist()
    texts += ["", " ", "\n\n  a", "don't  we'LL 12 34½", "日本語 text", "🙂🙂 x", "a b　c"]
    encoder, tokenizer = packing.Encoder(PATH), Tokenizer.from_file(PATH)
    for text in texts:
        assert encoder.ids(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_very_long_white_space(spark):
    """Runs that tiktoken's matcher cannot take, alone and inside a text."""
    runs = [" " * 1_200_000, "a" + "\n" * 1_100_000 + "b", "x" + " \t\n" * 400_000, " " * 100_001 + "y"]
    encoder, tokenizer = packing.Encoder(PATH), Tokenizer.from_file(PATH)
    for text in runs:
        assert encoder.ids(text) == tokenizer.encode(text, add_special_tokens=False).ids
    rows = [(i, t) for i, t in enumerate(runs)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string"), PATH).collect()
    for i, text in rows:
        n = len(tokenizer.encode(text, add_special_tokens=False).ids) + 1
        assert sum(p.length for p in pieces if p.doc_id == i) == n
