import base64
import hashlib
import random
import re

import pytest
import xxhash

from tidemark.llm import queries, spotsigs

SCHEMA = "doc_id bigint, text string, place int, part string, tail int"
COMMON = {w for line in spotsigs.ANCHORS for w in line.split()}


def is_anchor(word):
    return word in COMMON or xxhash.xxh3_64_intdigest(word) // 2 % spotsigs.SPACING == 0


def chains(text):
    """Anchor and the next two content words; the beginning counts as an anchor."""
    words = re.findall(r"\w+", text.lower())
    if not words:
        return set()
    out = set()
    for i in range(-1, len(words)):
        if i < 0 or is_anchor(words[i]):
            rest = [w for w in words[i + 1 :] if not is_anchor(w)]
            out.add((words[i] if i >= 0 else None, *rest[: spotsigs.CHAIN]))
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc_id, text, *_) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own = chains(text)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    jaccard(own, chains(edited)), jaccard(own, chains(following))))
    return sorted(out, key=repr)


def found(frame, **options):
    rows = spotsigs.compare_with_next(frame, **options).collect()
    picked = [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in rows]
    return sorted(picked, key=repr), rows


def corpus(seed, n):
    pick = random.Random(seed)
    words = "the of and river stone Green walk house é der wort la 日本 12".split()
    rows = [(i * 3, " ".join(pick.choice(words) for _ in range(pick.randint(0, 40))), 1, "", 2)
            for i in range(n)]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_against_brute_force(spark, parts):
    rows = corpus(parts, 120)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    picked, whole = found(frame, parts=parts)
    assert picked == expected(rows)
    for row in whole:
        assert len(base64.b64decode(row.fingerprint)) == 4 * row.n_signatures


def test_odd_rows(spark):
    rows = [(None, "the a b", 0, "", 0), (1, None, 0, "", 0), (2, "", 0, "", 0), (3, "?! \n", 0, "", 0),
            (4, "the of and", 0, "", 0), (5, "word " * 60_000, 0, "", 0), (6, "🙂🙂🙂 é", 0, "", 0),
            (7, "x", 0, "", 0), (7, "x", 0, "", 0), (7, "y", 0, "", 0)]
    picked, whole = found(spark.createDataFrame(rows, SCHEMA))
    assert picked == expected(rows)
    assert len({r.fingerprint for r in whole if r.doc_id in (1, 2, 3)}) == 1


def test_one_row_and_none(spark):
    rows = [(9, "the river of stone", 0, "", 0)]
    assert found(spark.createDataFrame(rows, SCHEMA))[0] == expected(rows)
    assert spotsigs.compare_with_next(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in documents.collect()]
    got = queries.op2_spotsigs_fingerprints(spark, sf_dir).collect()
    picked = [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got]
    assert sorted(picked, key=repr) == expected(rows)
    text = dict(rows)
    by_text = {}
    for r in got:
        assert by_text.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint


@pytest.mark.parametrize("percent", [75, 50])
def test_similar_pairs_against_all_pairs(spark, percent):
    pick = random.Random(percent)
    texts = ["", "..."]
    for _ in range(60):
        text = [pick.choice(["the", "of", "w%d" % pick.randrange(50)]) for _ in range(60)]
        for _ in range(3):
            copy = list(text)
            for _ in range(pick.randint(0, 6)):
                copy[pick.randrange(60)] = "x%d" % pick.randrange(9)
            texts.append(" ".join(copy))
    rows = [(i, t, 0, "", 0) for i, t in enumerate(texts)]
    sets = {i: frozenset(chains(t)) for i, t in enumerate(texts) if chains(t)}
    least = {}
    for i, s in sets.items():
        least.setdefault(s, i)
    own = list(least.items())
    pairs = {
        tuple(sorted((i, j))): jaccard(a, b)
        for n, (a, i) in enumerate(own) for b, j in own[:n] if 100 * jaccard(a, b) >= percent - 1e-9
    }
    got = spotsigs.similar(spark.createDataFrame(rows, SCHEMA), percent).collect()
    assert len(got) == len(pairs) > 5
    assert {tuple(sorted((r.a_doc_id, r.b_doc_id))): r.similarity for r in got} == pairs


def test_a_language_without_common_words(spark):
    """Texts of words that are no anchors of the four languages have many signatures, and an
    edit changes a part of them only."""
    pick = random.Random(9)
    words = ["".join(pick.choice("bdfgkmptz") + pick.choice("aou") for _ in range(3)) for _ in range(900)]
    assert not set(words) & COMMON
    texts = [" ".join(pick.choice(words) for _ in range(400)) for _ in range(20)]
    rows = [(i, t, 0, "", 0) for i, t in enumerate(texts)]
    found = spotsigs.compare_with_next(spark.createDataFrame(rows, SCHEMA)).collect()
    assert min(r.n_signatures for r in found) > 10
    assert len({r.fingerprint for r in found}) == 20
    assert all(0.2 < r.near_edited < 0.7 and r.near_next < 0.2 for r in found)


def test_members_of_classes(spark):
    rows = [(3, "the river", 0, "", 0), (1, "THE  river!", 0, "", 0), (2, "a stone", 0, "", 0),
            (None, "a stone", 0, "", 0), (None, "nobody knows", 0, "", 0), (4, None, 0, "", 0),
            (5, "...", 0, "", 0), (3, "the river", 0, "", 0)]
    found = spotsigs.members(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        [(3, 1), (3, 1), (1, 1), (2, 2), (None, 2), (None, None)], key=repr
    )
    assert spotsigs.members(spark.createDataFrame([], SCHEMA)).count() == 0
