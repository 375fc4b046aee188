"""Every text query over whole small tables: against its SQL, the tokenizer libraries or brute force."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as entry
from compare import compare, duck
from tillroll.llm import queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()
    return {r.doc_id: r.text or "" for r in rows}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    n, problems = compare(spark, duck(SF), queries.QUERIES[name], queries.ORACLES[name], SF)
    assert n and not problems, problems


def test_all_queries_are_registered():
    names = set(entry.queries())
    assert set(queries.QUERIES) <= names and "pipeline" in names
    assert {f"op{i}" for i in range(1, 14)} == {k.split("_")[0] for k in queries.QUERIES}


def base_counts(text):
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    places = defaultdict(list)
    for i in range(len(words) - 2):
        places[tuple(words[i:i + 3])].append(i)
    again = {i + d for p in places.values() if len(p) > 1 for i in p for d in range(3)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(again),
            len(words) < 50 or 100 * len(again) > 50 * len(words))


def test_op1_equals_brute_force(spark, docs):
    rows = queries.op1_quality_rules(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == base_counts(docs[r.doc_id]), r.doc_id
        assert r.kept == (not r.base_failed and r.n_removed_words <= 0.3 * r.n_words)


def test_op4_equals_tiktoken(spark, docs):
    import tiktoken

    enc = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=queries.byte_bpe.read_ranks(queries.MULTI_RANKS))
    rows = queries.op4_byte_bpe(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = np.array(enc.encode_ordinary(docs[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.TOKENIZER)


def check_packing(rows, texts, tokenizer):
    """Every id lies in exactly one piece; sequences are filled without gaps."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for d, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    sizes = []
    for s in range(len(sequences)):
        at = 0
        for offset, length in sorted(sequences[s]):
            assert offset == at and length > 0
            at += length
        sizes.append(at)
    assert all(x == 1024 for x in sizes[:-1]) and 0 < sizes[-1] <= 1024


def test_op6_packs_every_id_once(spark, docs, tokenizer):
    rows = queries.op6_packing(spark, SF).collect()
    check_packing(rows, docs, tokenizer)
    # windows hold the queues' shares of the tokens but for deficits below a slot, until a queue ends
    total = defaultdict(int)
    held = defaultdict(lambda: defaultdict(int))
    for r in rows:
        total[r.queue] += r.length
        held[r.sequence_id][r.queue] += r.length
    all_tokens = sum(total.values())
    running = defaultdict(int)
    for s in range(len(held) * 9 // 10):
        for q in total:
            running[q] += held[s][q]
            assert abs(running[q] - (s + 1) * 1024 * total[q] / all_tokens) <= 256 * len(total) + 1024, (s, q)


def test_op7_scores_held_out_rows(spark):
    rows = queries.op7_classifier(spark, SF.replace("0.001", "0.01")).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(
        SF.replace("0.001", "0.01") + "/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert len(held) > 50 and auc > 0.9
    assert rows == queries.op7_classifier(spark, SF.replace("0.001", "0.01")).collect()


def test_op9_equals_tokenizers(spark, docs, tokenizer):
    rows = queries.op9_token_counts(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n = len(tokenizer.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 1024)


def brute_components(texts, words=4):
    sets = {}
    for d, t in texts.items():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        k = min(words, len(w))
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
    top = {d: d for d in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def test_op10_equals_brute_force(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op10_minhash(spark, SF).collect()}
    assert got == brute_components(docs)
