"""Defined results for nulls, empty and long texts, ties, repeats, empty tables and clashing columns."""

import json
import os
import random
import re
import shutil
import struct

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from test_llm_queries import base_counts, brute_components, check_packing
from tillroll.llm import (byte_bpe, chat, classifier, encoding, exact_dedup, line_dedup, minhash, packing, quality_rules, queries,
                          token_counts, warc)
from tillroll.llm.common import schema_of

EXTRA = ", id STRING, at INT, key INT, a INT, b INT, n INT, digest INT, queue INT, value INT, first INT"
LONG = "word " * 30_000 + "x" * 20_000
TEXTS = [None, "", " \t\n ", "one", "a b c", "Ünï 你好 <|endoftext|> 12'll\n\n  x", "same text here again " * 20,
         "same text here again " * 20, LONG, "line one is here\nline two is here\nline three is here\nend"]


def frame(spark, texts=TEXTS):
    """Documents with a null id, a repeated row and columns that clash with the operators' own names."""
    rows = [(i, t, "en", None if i == 3 else f"s{i % 2}", 0) for i, t in enumerate(texts)]
    rows += [(None, "null id", None, None, None), rows[min(5, len(rows) - 1)]]
    rows = [(*r, "z", *[7] * 9) for r in rows]
    return spark.createDataFrame(rows, schema_of("documents") + EXTRA)


def empty(spark):
    return spark.createDataFrame([], schema_of("documents") + EXTRA)


def written(spark, tmp_path, df):
    path = str(tmp_path / "documents.parquet")
    df.coalesce(1).write.parquet(path)
    return path


RUNS = {
    "quality_rules": lambda d: quality_rules.judge_documents(d),
    "byte_bpe": lambda d: byte_bpe.encode_documents(d, queries.MULTI_RANKS, public_tokenizers.PATTERN),
    "packing": lambda d: packing.pack_documents(d, queries.TOKENIZER),
    "classifier": lambda d: classifier.score_documents(d, classifier.fit_quality(d, d.select(
        "doc_id", F.lit(1).alias("quality")))),
    "line_dedup": lambda d: line_dedup.dedup_lines(d),
    "token_counts": lambda d: token_counts.count_tokens(d, queries.TOKENIZER),
    "minhash": lambda d: minhash.near_duplicates(d),
    "keep_one": lambda d: minhash.keep_one(d, words=5),
    "clean": lambda d: quality_rules.clean_documents(d),
    "dedup_documents": lambda d: line_dedup.dedup_documents(d),
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_empty_tables_give_no_rows(spark, name):
    assert RUNS[name](empty(spark)).collect() == []


@pytest.mark.parametrize("name", ["clean", "keep_one", "dedup_documents"])
def test_filters_keep_all_columns(spark, name):
    d = frame(spark)
    assert RUNS[name](d).schema.simpleString() == d.schema.simpleString()


@pytest.mark.parametrize("name", ["quality_rules", "byte_bpe", "classifier", "line_dedup", "token_counts", "minhash"])
def test_one_row_per_input_row(spark, name):
    rows = RUNS[name](frame(spark)).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted([*map(str, range(len(TEXTS))), "5", "None"])


def test_quality_rules_counts(spark):
    for r in quality_rules.judge_documents(frame(spark)).collect():
        text = "null id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == base_counts(text)


def test_quality_rules_remove_lines_then_documents(spark):
    prose = " ".join(f"Sentence{i} number{i} says{i} this." for i in range(20))
    menu, notice = "Home | News | Sport | Contact", "All rights reserved"
    got = {r.doc_id: r for r in quality_rules.judge_documents(spark.createDataFrame(
        [(1, f"{menu}\n{prose}\n{notice}"), (2, "\n".join([f"Home{i} | News{i} | Sport{i} | Contact{i}" for i in range(30)] + [prose])),
         (3, prose)], "doc_id BIGINT, text STRING")).collect()}
    assert (got[1].kept, got[1].n_removed_lines, got[1].clean_text) == (True, 2, prose)
    assert not got[2].base_failed and not got[2].kept
    assert (got[3].kept, got[3].n_removed_lines) == (True, 0)


def test_tokens_of_odd_texts(spark):
    import tiktoken
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.TOKENIZER)
    enc = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=byte_bpe.read_ranks(queries.MULTI_RANKS))
    rng = random.Random(5)
    letters = "ab'st l  \n\t ​1²Ⅻé你\U0001f600<|.!_日本語ßא"
    texts = TEXTS + ["".join(rng.choices(letters, k=rng.randrange(1, 60))) for _ in range(400)]
    counts = {r.doc_id: r for r in token_counts.count_tokens(frame(spark, texts), queries.TOKENIZER).collect()}
    coded = {r.doc_id: r for r in byte_bpe.encode_documents(
        frame(spark, texts), queries.MULTI_RANKS, public_tokenizers.PATTERN).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        assert counts[i].n_tokens == len(tok.encode(t, add_special_tokens=False).ids), t[:80]
        assert np.frombuffer(coded[i].ids, "<u4").tolist() == enc.encode_ordinary(t), t[:80]


def test_packing_of_odd_texts(spark):
    from tokenizers import Tokenizer

    d = frame(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    for targets in (None, {"s0": 1.0, "s1": 3.0}):
        rows = packing.pack_documents(d, queries.TOKENIZER, targets=targets).collect()
        check_packing(rows, {i: t or "" for i, t in enumerate(TEXTS)}, Tokenizer.from_file(queries.TOKENIZER))


@pytest.mark.parametrize("targets", [None, {"s1": 2.0, "s3": 0.7, "absent": 5.0}])
def test_packing_by_sorted_slots_equals_the_closed_form(spark, monkeypatch, targets):
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["alpha", "beta", "gamma", "12", "é"], k=rng.choice([0, 3, 40, 700]))) for _ in range(150)]
    rows = [(i, t, f"s{min(rng.randrange(14), rng.randrange(14))}") for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING").repartition(5)
    want = packing.pack_documents(d, queries.TOKENIZER, targets=targets).collect()
    monkeypatch.setattr(packing, "MAX_QUEUES", 3)
    monkeypatch.setattr(packing, "SORT_SLOTS", 40)
    got = packing.pack_documents(d, queries.TOKENIZER, targets=targets).collect()
    assert sorted(got) == sorted(want) and len(want) > 150


def test_packing_of_more_queues_than_the_closed_form_takes(spark):
    from tokenizers import Tokenizer

    texts = {i: f"page {i} of its own site" for i in range(packing.MAX_QUEUES + 4)}
    rows = [(i, t, f"site{i}.example") for i, t in texts.items()]
    d = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")
    check_packing(packing.pack_documents(d, queries.TOKENIZER).collect(), texts, Tokenizer.from_file(queries.TOKENIZER))


def test_rank_encoder_equals_the_library():
    from tokenizers import Tokenizer

    with open(queries.TOKENIZER, "rb") as f:
        file = f.read()
    encoder, tok = packing.tokenizer_encoder(file), Tokenizer.from_str(file.decode())
    assert isinstance(encoder, encoding.RankEncoder)
    rng = random.Random(5)
    points = [c for c in [*range(0x3000), *range(0xfe00, 0x11000), *range(0x1f000, 0x1fb00)] if not 0xd800 <= c < 0xe000]
    texts = ["", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b", "'s't 'LL don't", "x" * 5000, " " * 3000 + "a"]
    texts += ["".join(chr(rng.choice(points)) if rng.random() < .3 else rng.choice("ab '\n\t1.Ã©sdlv<|>")
                      for _ in range(rng.randrange(60))) for _ in range(3000)]
    expected = [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.encode(texts) == expected
    encoder._alike[ord("b")] = encoding.DIFFERENT  # as if the libraries disagreed on it
    assert not encoder._fits("abc") and encoder._fits("acc")
    assert encoder.encode(texts) == expected


@pytest.mark.parametrize("change", [
    {"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}}, "order"])
def test_ranks_only_of_files_that_are_ranks(change):
    with open(queries.TOKENIZER) as f:
        settings = json.load(f)
    assert len(encoding.ranks_of(settings)) == 50_256
    if change == "order":
        settings["model"]["merges"][:2] = settings["model"]["merges"][1::-1]
    else:
        settings.update(change)
    assert encoding.ranks_of(settings) is None


def test_exact_dedup_nulls_and_colliding_digests(spark, tmp_path):
    path = written(spark, tmp_path, frame(spark))
    schema = schema_of("documents")
    exact = exact_dedup.dedup_table(spark, path, schema).collect()
    by_id = {r.doc_id: r for r in exact}
    assert [by_id[i].keep_id for i in (0, 1, 2, 6, 7)] == [0, 0, 2, 6, 6]
    assert (by_id[6].group_size, by_id[7].kept, by_id[None].kept) == (2, False, True)
    assert sorted(r.kept for r in exact if r.doc_id == 5) == [False, True]
    # digests of one bit: the full bytes decide
    weak = exact_dedup.dedup_table(spark, path, schema,
                                   digest=lambda t: F.substring(F.sha2(t, 256), 1, 1) < F.lit("8")).collect()
    assert sorted(map(str, weak)) == sorted(map(str, exact))


def test_exact_dedup_continues_its_state(spark, tmp_path):
    path, state = written(spark, tmp_path, frame(spark, ["x", "y"])), str(tmp_path / "state")
    exact_dedup.update_state(spark, path, schema_of("documents"), state)
    spark.createDataFrame([(-4, "x", "en", "s", 1)], schema_of("documents")).write.mode("append").parquet(path)
    exact_dedup.update_state(spark, path, schema_of("documents"), state)
    kept = sorted((r["first"]["id"] is None, r["first"]["id"] or 0, r["n"])
                  for r in exact_dedup.read_state(spark, state).collect())
    assert kept == [(False, -4, 2), (False, 1, 2), (True, 0, 1)]


def test_exact_dedup_continues_with_files_of_any_age(spark, tmp_path):
    path, state = written(spark, tmp_path, frame(spark, ["x", "y"])), str(tmp_path / "state")
    schema = schema_of("documents")
    exact_dedup.dedup_table(spark, path, schema, state_dir=state)
    old = tmp_path / "old"
    spark.createDataFrame([(-4, "x", "en", "s", 1), (9, "z", "en", "s", 1)], schema).coalesce(1).write.parquet(str(old))
    file = next(old.glob("*.parquet"))
    added = shutil.copy(file, f"{path}/{file.name}")
    os.utime(added, (10 ** 9, 10 ** 9))
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.dedup_table(
        spark, path, schema, state_dir=state).collect()}
    assert (got[0], got[-4], got[9]) == ((-4, 2), (-4, 2), (9, 1))


def test_exact_dedup_without_a_state_entry_is_an_error(spark, tmp_path, monkeypatch):
    whole = exact_dedup.read_state
    monkeypatch.setattr(exact_dedup, "read_state", lambda *a: whole(*a).where("n > 1"))
    with pytest.raises(Exception, match="no state for a text"):
        exact_dedup.dedup_table(spark, written(spark, tmp_path, frame(spark)), schema_of("documents")).collect()


def test_exact_dedup_of_an_empty_table(spark, tmp_path):
    assert exact_dedup.dedup_table(spark, written(spark, tmp_path, empty(spark)), schema_of("documents")).collect() == []


def brute_line_dedup(texts):
    seen, out = set(), {}
    for d, text in sorted(texts.items()):
        lines = text.split("\n")
        at = [i for i, x in enumerate(lines) if x.split()]
        gone = set()
        for j in range(len(at) - 2):
            key = tuple(lines[i] for i in at[j:j + 3])
            if key in seen:
                gone |= set(at[j:j + 3])
            seen.add(key)
        out[d] = (len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(3)
    texts = {i: "\n".join(rng.choice(["p", "q", "r", "", "s t"]) for _ in range(rng.randrange(0, 14)))
             for i in range(120)}
    d = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    got = {r.doc_id: (r.n_removed_lines, r.text) for r in line_dedup.dedup_lines(d).collect()}
    assert got == brute_line_dedup(texts)


def near_copies():
    """Groups of near copies of many sizes, a shared passage and unrelated texts."""
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(3000)}"
    shared, texts = [word() for _ in range(40)], []
    for size in (1, 2, 3, 40):
        for _ in range(4):
            base = [word() for _ in range(rng.randrange(60, 160))] + shared
            for _ in range(size):
                copy = list(base)
                for _ in range(rng.randrange(0, 5)):
                    copy[rng.randrange(len(copy))] = word()
                texts.append(" ".join(copy))
    rng.shuffle(texts)
    return dict(enumerate(texts))


def test_near_duplicates_equal_brute_force(spark):
    texts = near_copies()
    d = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(d).collect()}
    assert got == brute_components(texts)
    kept = sorted(r.doc_id for r in minhash.keep_one(d, words=5).collect())
    assert kept == sorted(i for i, x in brute_components(texts, 5).items() if x[2])


def test_near_copies_around_the_limit_of_one_text(spark):
    """Copies with up to eight changed, left out or added words: many are similar to a few others only."""
    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(500)}"
    base, texts = [word() for _ in range(120)], {}
    for i in range(400):
        copy = list(base)
        for _ in range(rng.randrange(1, 9)):
            at = rng.randrange(len(copy))
            copy[at:at + 1] = rng.choice(([], [word()], [copy[at], word()]))
        texts[i] = " ".join(copy)
    d = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    want = brute_components(texts)
    assert 50 < len({x[1] for x in want.values()}) < 350
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(d).collect()}
    assert got == want


def test_bloom_filter_has_all_its_values(spark):
    values = [-(2 ** 63), -1, 0, 1, 2 ** 63 - 1, *range(1000, 9000, 7)]
    filled = minhash.Bloom.of(spark.createDataFrame([(v,) for v in values], "x BIGINT").repartition(3), "x", len(values))
    assert filled.has(np.array(values)).all()
    assert filled.has(np.arange(10 ** 6, 10 ** 6 + 10_000)).mean() < 0.2
    empty = minhash.Bloom.of(spark.createDataFrame([], "x BIGINT"), "x", 0)
    assert not empty.has(np.arange(100)).any()


def test_near_duplicates_at_the_limit_with_few_equal_coordinates(spark):
    texts = {}
    for seed in (4408, 5207, 6375, 9462, 9642, 19289):  # 8 of 10 shingles in common, 37 to 39 equal coordinates
        rng = random.Random(seed)
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(13)]
        texts |= {2 * seed: " ".join(words), 2 * seed + 1: " ".join(words[:11])}
        a, b = (minhash.shingle_set(texts[2 * seed + i].encode()) for i in (0, 1))
        assert minhash.jaccard(a, b) == (8, 10) and (minhash.signature(a) == minhash.signature(b)).sum() < 40
    d = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(d).collect()}
    assert got == brute_components(texts)


def test_near_duplicates_of_empty_and_null(spark):
    got = minhash.near_duplicates(frame(spark)).collect()
    by_id = {r.doc_id: r for r in got}
    assert [(by_id[i].n_shingles, by_id[i].component_id, by_id[i].kept) for i in (0, 1, 2)] == [
        (0, i, True) for i in range(3)]
    assert by_id[7].component_id == 6 and not by_id[7].kept and by_id[None].kept


def test_trees_walk_like_a_plain_loop():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, len(classifier.FEATURES)))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    model = classifier.fit_trees(x[:400], y[:400])
    got = model.score(x[400:])
    for row, score in zip(x[400:], got):
        margin = model.prior
        for f, t, leaf in zip(model.feature, model.threshold, model.leaf):
            at = 0
            while at < len(f):
                at = 2 * at + 1 + int(row[f[at]] > t[at])
            margin += leaf[at - len(f)]
        assert abs(score - 1 / (1 + np.exp(-margin))) < 1e-9
    assert ((got > 0.5) == (y[400:] > 0.5)).mean() > 0.9


def test_classifier_without_usable_labels_and_with_ties(spark):
    d = frame(spark)
    none = d.select("doc_id", F.lit(None).cast("int").alias("quality"))
    assert {r.score for r in classifier.score_documents(d, classifier.fit_quality(d, none)).collect()} == {0.5}


def test_warc_round_trip_of_odd_pages(spark, tmp_path):
    rows = [(3, "u", "same"), (1, None, "same"), (2, "ü ä", None), (5, "u", ""), (None, "u", "same"), (1, "u", "same"),
            (9, "u", "é" * 50_000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], schema_of("pages") + ", sha INT")
    warc.write_archives(pages, str(tmp_path / "w"))
    got = warc.read_archives(spark, str(tmp_path / "w"), with_payload=True).collect()
    assert sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in got) == sorted([
        ("3", "revisit", 1, 4), ("1", "response", None, 4), ("1", "response", None, 4), ("2", "response", None, 0),
        ("5", "revisit", 2, 0), ("None", "revisit", 1, 4), ("9", "response", None, 100_000)])
    assert {bytes(r.payload) for r in got if r.page_id == 1} == {b"same"}


def test_warc_of_no_pages(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], schema_of("pages")), str(tmp_path / "w"))
    assert warc.read_archives(spark, str(tmp_path / "w")).collect() == []


def archive():
    import base64
    import hashlib

    out = []
    for i in range(400):
        body = (f"<html>{i} " + "some words in a page " * 30 + str(i * i)).encode()
        out.append(warc.make_record(i, "u", body, base64.b32encode(hashlib.sha1(body).digest()).decode(), None, False,
                                    "1970-01-01T00:00:00Z"))
    return out, warc.make_archive(out)


def test_warc_archive_has_a_leading_dictionary_and_one_frame_per_record():
    records, data = archive()
    assert struct.unpack_from("<I", data)[0] == warc.DICTIONARY_MAGIC
    assert list(warc.read_archive(data)) == records


@pytest.mark.parametrize("harm", ["cut", "flip", "tail", "length", "digest"])
def test_warc_rejects_damage(harm):
    records, data = archive()
    with pytest.raises(ValueError):
        if harm == "cut":
            list(warc.read_archive(data[:-3]))
        elif harm == "flip":
            list(warc.read_archive(data[:-40] + bytes([data[-40] ^ 255]) + data[-39:]))
        elif harm == "tail":
            list(warc.read_archive(data + b"garbage!"))
        elif harm == "length":
            warc.parse_record(records[0].replace(b"Content-Length: ", b"Content-Length: 1", 1))
        else:
            warc.parse_record(records[0].replace(b"some words", b"Some words", 1))


def tree(spark):
    rows = [(1, 1, None, "user", "hi <|im_end|>", 0.0), (1, 2, 1, "assistant", "low", 0.1),
            (1, 3, 1, "assistant", "high <||", 0.9), (1, 4, 3, "user", None, None), (1, 5, 4, "assistant", "end", 0.5),
            (1, 6, 99, "user", "orphan", 9.0), (1, 7, 8, "user", "circle", 9.0), (1, 8, 7, "user", "circle", 9.0),
            (2, 1, None, None, "alone", None), (None, 1, None, "user", "no tree", 1.0)]
    return spark.createDataFrame([(*r, 0, 0) for r in rows], "tree BIGINT, node BIGINT, parent BIGINT, role STRING, "
                                 "text STRING, score DOUBLE, up INT, leaf INT")


def test_reply_trees_rank_branches_and_round_trip(spark):
    out = chat.format_trees(tree(spark), best=2).withColumn("turns", chat.read_turns(F.col("formatted")))
    out = out.withColumn("loss", chat.read_loss(F.col("turns"), F.col("loss_runs"))).collect()
    got = {(r.tree, r.branch): ([(t.role, t.text) for t in r.turns], r.loss) for r in out}
    assert got == {
        (1, 1): ([("user", "hi <|im_end|>"), ("assistant", "high <||"), ("user", ""), ("assistant", "end")],
                 "high <||end"),
        (1, 2): ([("user", "hi <|im_end|>"), ("assistant", "low")], "low"),
        (2, 1): ([("", "alone")], ""), (None, 1): ([("user", "no tree")], "")}
    for r in out:
        assert sum(x.chars for x in r.loss_runs) == len(r.formatted)


def test_reply_paths_of_long_and_random_trees(spark):
    rng = random.Random(2)
    parents = {(t, n): (None if n == 0 else n - 1 if t == 0 else rng.randrange(n)) for t in range(3) for n in range(70)}
    d = spark.createDataFrame([(t, n, p) for (t, n), p in parents.items()], "tree BIGINT, node BIGINT, parent BIGINT")
    want = set()
    for t, leaf in parents:
        if (t, leaf) not in {(t, p) for (t, _), p in parents.items()}:
            node, up = leaf, 0
            while node is not None:
                want.add((t, leaf, node, up))
                node, up = parents[t, node], up + 1
    assert {(r.tree, r.leaf, r.node, r.up) for r in chat.reply_paths(d).collect()} == want


def test_chat_of_no_rows(spark):
    assert chat.format_trees(chat.chains(spark.createDataFrame([], schema_of("conversations")))).collect() == []


def test_line_dedup_keeps_columns_of_any_name(spark):
    rows = [(i, "a\nb\nc\nd" if i < 3 else f"x{i}\ny{i}\nz\nw", *[f"{i}-{c}" for c in range(9)]) for i in range(5)]
    names = ["doc_id", "text", "__key", "__id", "__text", "key", "id", "lines", "gone", "u0", "removed"]
    d = spark.createDataFrame(rows, names)
    got = {r.doc_id: r for r in line_dedup.dedup_documents(d, length_col=None).collect()}
    assert line_dedup.dedup_documents(d, length_col=None).columns == names
    for r in rows:
        assert tuple(got[r[0]])[2:] == r[2:] and got[r[0]].text == (r[1] if r[0] in (0, 3, 4) else "")


def test_equal_first_hashes_of_lines_say_nothing_of_the_second(spark):
    """The second hash is no function of the first: it starts from another seed, not from the first hash."""
    import xxhash

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    lines = ["", "a", "line one", "Ünï 你好" * 9]
    d = spark.createDataFrame([(x,) for x in lines], "line STRING")
    seed = xxhash.xxh64_intdigest(struct.pack("<i", line_dedup._SALT), 42)
    for r in d.select("line", *[h.alias(c) for h, c in zip(line_dedup.line_hashes(F.col("line")), "ab")]).collect():
        assert r.a == signed(xxhash.xxh64_intdigest(r.line.encode(), 42))
        assert r.b == signed(xxhash.xxh64_intdigest(r.line.encode(), seed))


@pytest.mark.parametrize("name", ["plain/", "a[b]c{d,e}", "what?*"])
def test_exact_dedup_takes_paths_as_they_are(spark, tmp_path, name):
    path = f"{tmp_path}/{name}"
    os.makedirs(path)
    frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/made")
    made = [f for f in os.listdir(f"{tmp_path}/made") if f.endswith(".parquet")][0]
    shutil.copy(f"{tmp_path}/made/{made}", f"{path.rstrip('/')}/{made}")
    got = exact_dedup.dedup_table(spark, path, schema_of("documents")).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted([*map(str, range(len(TEXTS))), "5", "None"])


def test_seen_bits_let_all_seen_rows_pass(spark):
    from tillroll.llm import common

    d = spark.range(5000).select("id", F.xxhash64("id").alias("h"))
    bits = common.seen_bits(F.col("h"), d.where("id % 50 = 0"))
    seen, other = (x.select("id").collect() for x in common.split_seen(d, F.col("h"), bits))
    seen, other = {r.id for r in seen}, {r.id for r in other}
    assert set(range(0, 5000, 50)) <= seen and len(seen) < 200 and seen | other == set(range(5000)) and not seen & other
    none, rest = common.split_seen(d, F.col("h"), common.seen_bits(F.col("h"), d.limit(0)))
    assert none.count() == 0 and rest.count() == 5000


def test_chunk_maps_compose_associatively():
    rng = random.Random(2)
    for _ in range(300):
        a, b, c = ({token_counts.ANY: rng.randrange(4)} if rng.random() < 0.2 else
                   {i: rng.randrange(4) for i in rng.sample(range(4), rng.randrange(5))} for _ in range(3))
        join = token_counts.compose
        assert join(join(a, b), c) == join(a, join(b, c))
    maps = [{token_counts.ANY: 0}] + [{i: rng.randrange(4) for i in range(4)} for _ in range(40)]
    want = [maps[0]]
    for m in maps[1:]:
        want.append(token_counts.compose(want[-1], m))
    assert token_counts.prefix_maps(maps) == want and all(token_counts.ANY in m for m in want)


def test_counts_of_runs_without_a_pretoken_start():
    from tokenizers import Tokenizer

    file = open(queries.TOKENIZER, "rb").read()
    counter, tok = token_counts.TokenCounter(file), Tokenizer.from_str(file.decode())
    rng = random.Random(6)
    texts = ["a" * 3000, "日本語" * 4000, "".join(rng.choices("etaoin", k=30_000)), "".join(rng.choices("abcxyz", k=5000)) + " x",
             "ab" * 9000 + " word " + "q" * 2000, "".join(rng.choices("letrs", k=1_000_000))]
    assert counter.count(texts) == [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    again = token_counts.TokenCounter(file)
    assert again.count(texts[:2]) == counter.count(texts[:2])


def changed_tokenizer(tmp_path, **changes):
    settings = json.load(open(queries.TOKENIZER))
    for part, values in changes.items():
        settings[part] = {**settings[part], **values} if settings.get(part) and values else values
    path = tmp_path / "changed.json"
    path.write_text(json.dumps(settings))
    return path.read_bytes()


@pytest.mark.parametrize("changes", [{"pre_tokenizer": {"add_prefix_space": True}}, {"pre_tokenizer": {"use_regex": False}},
                                     {"normalizer": {"type": "Lowercase"}}, {"model": {"dropout": 0.5}}])
def test_unsupported_tokenizers_are_errors(tmp_path, changes):
    file = changed_tokenizer(tmp_path, **changes)
    for make in (packing.tokenizer_encoder, token_counts.TokenCounter):
        with pytest.raises(ValueError):
            make(file)


def test_other_patterns_are_errors():
    ranks = byte_bpe.read_ranks(queries.MULTI_RANKS)
    with pytest.raises(ValueError):
        byte_bpe.ByteBpe(byte_bpe.model_bytes(ranks), r"\w+|\W+")
    byte_bpe.ByteBpe(byte_bpe.model_bytes(ranks), public_tokenizers.PATTERN)


def test_many_queues_are_scheduled_at_once():
    import time

    rng = np.random.default_rng(1)
    began = time.time()
    totals = rng.integers(0, 5000, packing.MAX_QUEUES).tolist()
    schedule = packing.Schedule(totals, [max(t, 1) for t in totals], 256, 1024)
    assert time.time() - began < 20
    queue = np.repeat(np.arange(len(totals)), schedule.slots)
    k = np.arange(len(queue)) - np.repeat(np.cumsum(schedule.slots) - schedule.slots, schedule.slots)
    place = schedule.position(queue, k)
    size = np.minimum(256, np.array(totals)[queue] - 256 * k)
    order = np.argsort(place)
    assert (place[order] == np.cumsum(size[order]) - size[order]).all()


def test_extreme_targets_place_every_slot_once():
    totals = [5_000_000, 5_000_000]
    schedule = packing.Schedule(totals, [1.0, 1e-9], 256, 1024)
    queue = np.repeat(np.arange(2), schedule.slots)
    k = np.concatenate([np.arange(n) for n in schedule.slots])
    place = schedule.position(queue, k)
    size = np.minimum(256, np.array(totals)[queue] - 256 * k)
    order = np.argsort(place)
    assert (place[order] == np.cumsum(size[order]) - size[order]).all()
    assert place[queue == 0].max() < place[queue == 1].min()
    with pytest.raises(ValueError):
        packing.Schedule([1 << 60], [1.0], 256, 1024)


TREE = "tree BIGINT, node BIGINT, parent BIGINT, role STRING, text STRING, score DOUBLE"


def test_all_branches_and_repeated_messages(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 5.0),
            (1, 3, 1, "assistant", "b", 5.0), (1, 2, 1, "assistant", "other", 1.0), (1, None, 1, "user", "no node", 9.0),
            (2, 1, None, "user", "word " * 100_000, None)]
    for repeat in (1, 2):
        got = chat.format_trees(spark.createDataFrame(rows * repeat, TREE), best=None).collect()
        got = {(r.tree, r.branch): r for r in got}
        assert set(got) == {(1, 1), (1, 2), (2, 1)}
        assert (got[1, 1].leaf, got[1, 1].score, got[1, 1].n_turns) == (3, 5.0, 2) and "b<|im_end|>" in got[1, 1].formatted
        assert got[1, 2].n_turns == 2 and ("a<|im_end|>" in got[1, 2].formatted) != ("other<|im_end|>" in got[1, 2].formatted)
        if repeat == 1:
            first = got[1, 2].formatted
        assert got[1, 2].formatted == first and len(got[2, 1].formatted) > 500_000
    best = chat.format_trees(spark.createDataFrame(rows, TREE), best=1).collect()
    assert sorted((r.tree, r.leaf) for r in best) == [(1, 3), (2, 1)]


def test_texts_meet_only_the_chosen_paths(spark):
    """Nothing but keys is joined before the choice."""
    rows = [(t, n, None if n == 1 else 1, "user", f"text {n}", float(n)) for t in (1, 2) for n in range(1, 200)]
    plan = chat.format_trees(spark.createDataFrame(rows, TREE))._jdf.queryExecution().optimizedPlan().toString()
    before_choice = plan.split("row_number()")[1]  # what lies below the ranking of branches
    assert "row_number()" in plan and "text#" not in before_choice and "role#" not in before_choice


def any_record(kind, body, version="1.1", id_="<urn:uuid:6a1c>", **headers):
    head = {"WARC-Type": kind, "WARC-Record-ID": id_, "WARC-Date": "2024-02-29T12:00:00Z", **headers, "Content-Length": len(body)}
    return f"WARC/{version}\r\n".encode() + "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + body + b"\r\n\r\n"


def test_warc_reads_records_of_any_kind(spark, tmp_path):
    import base64
    import hashlib

    page = b"HTTP/1.1 404 Not Found\r\nContent-Type: text/html\r\nX-Long: a\r\n b\r\n\r\n<p>gone</p>"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n4\r\nabcd\r\n0\r\n\r\n"
    digest = "sha1:" + base64.b32encode(hashlib.sha1(b"<p>gone</p>").digest()).decode()
    records = [
        any_record("warcinfo", b"software: x\r\n", "1.0", Content_Type="application/warc-fields"),
        any_record("request", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", Content_Type="application/http; msgtype=request"),
        any_record("response", page, WARC_Target_URI="http://x/", WARC_Payload_Digest=digest, Content_Type="application/http; msgtype=response"),
        any_record("response", chunked, WARC_Payload_Digest="sha1:" + "A" * 32, Content_Type="application/http"),
        any_record("metadata", b"via: y", WARC_Concurrent_To="<urn:uuid:1>"), any_record("conversion", "schön".encode()),
        any_record("resource", b"", "1.0"),
        any_record("revisit", b"HTTP/1.1 200 OK\r\n\r\n", Content_Type="application/http", WARC_Refers_To="<urn:uuid:6a1c>")]
    (tmp_path / "a.warc.zst").write_bytes(warc.make_archive(records))
    (tmp_path / "b.warc.zst").write_bytes(warc.make_archive([]))
    got = warc.read_records(spark, str(tmp_path)).collect()
    assert [r.record_type for r in got] == ["warcinfo", "request", "response", "response", "metadata", "conversion", "resource", "revisit"]
    assert [r.status for r in got] == [None, None, 404, 200, None, None, None, 200]
    assert got[2].payload == b"<p>gone</p>" and got[2].http_headers["X-Long"] == "a b" and got[2].target_uri == "http://x/"
    assert got[5].payload.decode() == "schön" and got[7].refers_to == "<urn:uuid:6a1c>" and got[0].headers["WARC-Type"] == "warcinfo"
    assert all(r.file.endswith("a.warc.zst") and r.record_id == "<urn:uuid:6a1c>" for r in got)
    for harm in ((digest[:10], "sha1:AAAAA"), ("WARC/1.1", "WARC/0.9"), ("Content-Length: ", "Content-Length: 9")):
        with pytest.raises(ValueError):
            warc.parse_any(records[2].replace(*[x.encode() for x in harm]))
    hexed = any_record("resource", b"abc", WARC_Payload_Digest="sha1:" + hashlib.sha1(b"abc").hexdigest(), WARC_Block_Digest="md5:x")
    assert warc.parse_any(hexed)["payload"] == b"abc"


def test_warc_files_hold_many_chunks_with_one_dictionary(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK_BYTES", 400_000)
    monkeypatch.setattr(warc, "ARCHIVE_CHUNKS", 3)
    rng = random.Random(1)
    pages = [(i, "u", f"{i} " + " ".join(f"word{rng.randrange(500)}" for _ in range(600))) for i in range(900)]
    warc.write_archives(spark.createDataFrame(pages, schema_of("pages")).coalesce(1), str(tmp_path / "w"))
    files = sorted(f for f in os.listdir(tmp_path / "w") if f.startswith("part-"))
    data = [(tmp_path / "w" / f).read_bytes() for f in files]
    assert len(files) >= 2 and all(struct.unpack_from("<I", d)[0] == warc.DICTIONARY_MAGIC for d in data)
    assert all(d.count(struct.pack("<I", warc.DICTIONARY_MAGIC)) == 1 for d in data)
    got = {r.page_id: bytes(r.payload) for r in warc.read_archives(spark, str(tmp_path / "w"), with_payload=True).collect()}
    assert got == {i: t.encode() for i, _, t in pages}


def plain_line_fails(line):
    """The three line rules, written again over characters."""
    words = [w for w in "".join(" " if c in "\x20\x09\x0a\x0b\x0c\x0d" else c for c in line).split(" ") if w]
    odd = sum(c in "#*$%&|<>!~^=+{}[]\\@_" for c in line)
    punctuation = odd >= 2 and odd / len(words) > 0.5 or len(words) >= 60 and not any(c in ".!?:;,…。！？،।" for c in line)
    menu = sum(line.count(s) for s in ("|", " > ", "»", "·", "•", " / ", "→"))
    navigation = menu >= 3 and menu / len(words) >= 0.2
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
    phrases = [p.decode() for p in quality_rules.PHRASES]
    return punctuation or navigation or len(words) <= 40 and any(p in low for p in phrases)


def test_line_verdicts_equal_brute_force_on_a_whole_table(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    removed = 0
    for r in quality_rules.judge_documents(table).collect():
        text = docs[r.doc_id]
        counts = base_counts(text)
        lines = text.split("\n")
        gone = [x for x in lines if x.split() and plain_line_fails(x)]
        lost = sum(len([w for w in re.split("[\x20\x09-\x0D]+", x) if w]) for x in gone)
        assert (r.n_removed_lines, r.n_removed_words) == (len(gone), lost), r.doc_id
        assert r.kept == (not counts[5] and lost <= 0.3 * counts[0])
        assert r.clean_text == "\n".join(x for x in lines if x not in gone)
        removed += len(gone)
    assert removed > 20


def test_first_split_equals_brute_force():
    """The root of the first tree is the split of the largest gain over all bins of all features."""
    rng = np.random.default_rng(5)
    for _ in range(5):
        x = np.round(rng.normal(size=(300, 4)), 1)
        y = (x[:, rng.integers(4)] + 0.5 * rng.normal(size=300) > 0.2).astype(float)
        model = classifier.fit_trees(x, y, trees=1, depth=1, bins=16)
        p = y.mean()
        grad, hess = p - y, np.full(300, p * (1 - p))

        def gain(right):
            side = lambda m: grad[m].sum() ** 2 / (hess[m].sum() + 1)
            small = min(hess[right].sum(), hess[~right].sum()) < 5
            return 0 if small else side(right) + side(~right) - grad.sum() ** 2 / (hess.sum() + 1)

        cuts = {(f, c) for f in range(4) for c in np.unique(np.quantile(x[:, f], np.linspace(0, 1, 17)[1:-1]))}
        best = max(gain(x[:, f] > c) for f, c in cuts)
        right = x[:, model.feature[0, 0]] > model.threshold[0, 0]
        assert abs(gain(right) - best) < 1e-9
        for leaf, rows in zip(model.leaf[0], (~right, right)):
            assert abs(leaf + 0.2 * grad[rows].sum() / (hess[rows].sum() + 1)) < 1e-9
