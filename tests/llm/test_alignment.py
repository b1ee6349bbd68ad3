import hashlib
import json
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment, queries

A, B = queries.TOKENIZER, queries.PIECES
SCHEMA = "doc_id bigint, text string, links string, n int, pairs int, block int"


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    return a, b


@pytest.fixture(scope="module")
def letters():
    """Bytes of the letters of byte-level vocabularies, read off the vocabulary's file."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), 256)]
    table, extra = {chr(b): b for b in own}, 0
    for b in range(256):
        if b not in own:
            table[chr(256 + extra)] = b
            extra += 1
    with open(A, encoding="utf-8") as file:
        assert set("".join(t for t in json.load(file)["model"]["vocab"] if "<|" not in t)) <= set(table)
    return table


def tokens(sides, letters, text):
    """(id, end) of the tokens of both sides, or none."""
    raw = (" " + (text or "")).encode()
    if not text:
        return [], []
    a, b = sides
    out = []
    found = a.encode(" " + text, add_special_tokens=False)
    pieces = b.encode(text)
    sizes_a = [bytes(letters[c] for c in t) for t in found.tokens]
    sizes_b = []
    for i in pieces:
        piece = b.id_to_piece(i)
        byte = len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">")
        sizes_b.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode())
    for ids, parts in ((found.ids, sizes_a), (pieces, sizes_b)):
        if b"".join(parts) != raw:
            return [], []
        end, own = 0, []
        for i, part in zip(ids, parts, strict=True):
            end += len(part)
            own.append((i, end))
        out.append(own)
    return out


def expected(sides, letters, rows):
    parts = [(doc_id, *tokens(sides, letters, text)) for doc_id, text in rows]
    pairs = [[(x, y) for x, e in a for y, f in b if e == f] for _, a, b in parts]
    count = Counter(p for own in pairs for p in own)
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    out = []
    for (doc_id, a, b), own in zip(parts, pairs, strict=True):
        cuts = sorted({e for _, e in a} & {e for _, e in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(
                ",".join(str(i) for i, e in side if low < e <= cut) for side in (a, b)))
            low = cut
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        best = sum(count[p] == most[p[1]] for p in own)
        out.append((doc_id, len(a), len(b), len(groups), len(own), best,
                    sum(count[p] for p in own), digest))
    return sorted(out, key=str)


TEXTS = [
    None, "", " ", "a", "the cat sat on the mat", "Der Fuß des Löwen, groß!", "naïve café 🙂🙂 日本語 text",
    "▁under", "a▁b", "x\ty\n\n\nz   w", "<|endoftext|> <s> </s> <unk> <0x41>", "   x", "ﬁ ½ Ⅳ",
    "1234567890 3.14159 0x1F", "aaaaaaaaaaaaaaaaaaaaaaaa", "token = \"9f86d081884c7d65\"", "the cat sat",
    "\x00\x01 nul", "é", " leading", "trailing ", "the the the the", "🏳️‍🌈",
]


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], SCHEMA)
    found = alignment.align(df, A, B, **options)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                             "groups_sha256"]
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("block_bytes", [1, 100, 1 << 20])
def test_brute_force(spark, sides, letters, block_bytes):
    rows = [*enumerate(TEXTS), (3, "the cat sat"), (3, "the cat sat"), (None, "the mat")]
    assert run(spark, rows, block_bytes=block_bytes) == expected(sides, letters, rows)


def test_documents(spark, sf_dir, sides, letters):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("n_chars < 1500")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()][:120]
    assert run(spark, rows) == expected(sides, letters, rows)


def test_special_strings_are_plain_text(spark, sides, letters):
    [found] = run(spark, [(1, "a <|endoftext|> b")])
    assert found[1] > 4 and found == expected(sides, letters, [(1, "a <|endoftext|> b")])[0]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_texts_without_tokens_only(spark):
    zeros = (0, 0, 0, 0, 0, 0, "")
    assert run(spark, [(1, None), (2, ""), (None, "▁")]) == sorted(
        [(1, *zeros), (2, *zeros), (None, *zeros)], key=str
    )


def test_long_text(spark):
    text = "word " * 100_000 + " " * 1_200_000 + "x"
    [found] = run(spark, [(1, text)])
    assert found[3] == found[4] > 100_000


def test_pair_counts(spark, sides, letters):
    rows = list(enumerate(TEXTS))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r.a_id, r.b_id): r.n for r in alignment.pair_counts(df, A, B).collect()}
    pairs = Counter(
        (x, y) for _, t in rows for a, b in [tokens(sides, letters, t)]
        for x, e in a for y, f in b if e == f
    )
    assert found == pairs


def test_tokens_without_bytes():
    sizes = [1, 0, 2]
    assert alignment._ending([0, 2, 1, 1], 0, 4, sizes) == [2, 1, 1]
    assert alignment._ending([0], 0, 1, sizes) == [0]
    assert alignment.slices({1: 1, 3: 2}, {2: 1, 3: 3}) == ([2], [3])


def test_query(spark, sf_dir):
    found = queries.op13_tokenizer_alignment(spark, sf_dir)
    rows = found.collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.n_groups == r.n_links and r.n_best <= r.n_links <= r.count_sum for r in rows)
