"""The methods of the operators on small inputs: exactness, held-out accuracy, bounds."""

import io
import random
from collections import Counter

import numpy as np
import pytest

from fieldstats.llm import archives, decontam, mixing, near, secrets, topk, toxicity, urls, words

GIVEN = "/root/testdata/sf0.01"


def test_schedule_is_never_a_block_off():
    for weights in ({"a": 5, "b": 3, "c": 1.5, "d": 0.01}, {f"s{i}": 1 + i % 4 for i in range(37)}, {"only": 1}, {"x": 0, "y": 1}):
        quota, period = mixing.quotas(weights, 200)
        assert sum(quota.values()) == period
        done = Counter()
        for source, block, slot in mixing.period_slots(quota, period):
            assert done[source] == block
            done[source] += 1
            for s in quota:
                assert abs(done[s] - (slot + 1) * quota[s] / period) < 1
        assert done == quota


def test_mixture_follows_the_schedule(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "case when id % 2 = 0 then 'big' when id % 4 = 1 then 'mid' end as source", "'x' as slot", "id as k")
    got = mixing.mixed(spark, docs, {"big": 2, "mid": 1, None: 1}, block_rows=10).toPandas()
    assert len(got) == 4000 and got.groupby(["slot", "row_in_block"]).size().max() == 1
    first = got[got["slot"] < 200]
    shares = first["source"].fillna("none").value_counts() / len(first)
    assert abs(shares["big"] - 0.5) < 0.01 and abs(shares["mid"] - 0.25) < 0.01 and abs(shares["none"] - 0.25) < 0.01


def test_random_strings_are_told_from_identifiers(spark):
    rnd = random.Random(5)
    syllables = "con fig ura tion man ager hand ler ser vice re quest to ken buf fer in dex ta ble co lumn read wri ter".split()
    name = lambda: "".join(rnd.choice(syllables) for _ in range(7))
    key = lambda: "".join(rnd.choice(secrets.ALPHABET[:62]) for _ in range(30))
    rows = [(name(), False) for _ in range(400)] + [(key(), True) for _ in range(400)] + [(None, True)]
    model = secrets.fit(spark.createDataFrame(rows, "word string, random boolean"))
    held_out = [(name(), False) for _ in range(100)] + [(key(), True) for _ in range(100)]
    frame = spark.createDataFrame(held_out, "word string, random boolean")
    got = frame.select((secrets.ratio(frame["word"], model) >= secrets.LIMIT).alias("found"), "random").collect()
    assert sum(r["found"] == r["random"] for r in got) >= 198
    docs = spark.createDataFrame([(1, f"x {held_out[-1][0]} {held_out[0][0]}.")], "doc_id long, text string")
    found = secrets.scanned(docs, model)
    row = found.select(secrets.redacted(found["text"], found["found"]).alias("t")).first()
    assert row["t"] == f"x [SECRET] {held_out[0][0]}."


def test_toxicity_on_held_out_rows(spark):
    from pyspark.sql import functions as F

    from fieldstats.llm.queries import CATEGORIES, category_labels, table

    folder = "/root/testdata/sf0.1"  # smaller tables have too few toxic rows; some labelled toxic here hold nothing toxic
    docs, labels = table(spark, folder, "documents"), category_labels(table(spark, folder, "labels"))
    apart = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    models = toxicity.fit(spark, docs, labels.where(~apart), CATEGORIES)
    got = toxicity.scored(spark, docs, models, CATEGORIES).join(labels.where(apart).select("doc_id", "toxic"), "doc_id").toPandas()
    assert got.loc[got["toxic"] == 1, "rejected"].mean() >= 0.9 and got.loc[got["toxic"] == 0, "rejected"].mean() <= 0.01


def test_chain_feeds_earlier_probabilities():
    rnd = np.random.default_rng(0)
    y = rnd.integers(0, 2, (600, 2))
    y[:, 1] = y[:, 0]  # the second category has no features of its own but what the first one knows
    rows = [np.array([1 + a, 100 + int(rnd.integers(0, 50))], dtype=np.int32) for a in y[:, 0]]
    models = toxicity.chain_of(rows, y, np.arange(600) % toxicity.FOLDS)
    p = toxicity.chained(models, rows)
    assert ((p >= 0.5) == (y == 1)).mean() > 0.99 and len(models[1].chain) == 1 and models[1].chain[0] > 0
    assert toxicity.chained(toxicity.chain_of([], np.zeros((0, 2), dtype=int), np.zeros(0, dtype=int)), rows).max() < 0.5


def test_common_subsequence():
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    rnd = random.Random(1)
    for _ in range(200):
        a, b = ([rnd.randrange(6) for _ in range(rnd.randrange(1, 90))] for _ in range(2))
        assert decontam.common_subsequence(a, b) == plain(a, b)


def test_word_hashes_agree_with_splitting():
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("aB é\n\t.\x0b\x1c") for _ in range(rnd.randrange(60))).encode() for _ in range(200)] + [b"x " * (words.BLOCK_BYTES // 2 + 7), b"y" * (words.BLOCK_BYTES * 2 + 3)]
    owner, hashed = words.Hasher().words(texts)
    flat = [w for t in texts for w in t.lower().split()]
    assert np.bincount(owner, minlength=len(texts)).tolist() == [len(t.split()) for t in texts]
    assert len(set(hashed.tolist())) == len(set(flat)) == len(set(zip(hashed.tolist(), flat, strict=True)))


def test_sliced_block_is_exact():
    rnd = np.random.default_rng(3)
    for dim, n, scale in ((1, 5, 3), (8, 700, 400), (64, 300, 2), (16, 130, 1 << 30), (0, 4, 1), (4, 200, 0)):
        vectors = rnd.integers(-scale, scale + 1, (n, dim))
        ids = rnd.permutation(n).astype(np.int64)
        block = topk.SlicedBlock(ids, vectors)
        for q in vectors[:20]:
            exact = [int(sum(int(a) * int(b) for a, b in zip(q, v, strict=True))) for v in vectors]
            want = sorted((-s, i) for s, i in zip(exact, ids.tolist(), strict=True) if i != 2)[:10]
            got_ids, got = block.best(q, 10, 2)
            assert [(-s, i) for s, i in want] == [(int(s), int(i)) for s, i in zip(got, got_ids, strict=True)] or want == [(-int(s), int(i)) for s, i in zip(got, got_ids, strict=True)]


def test_archives_of_both_versions():
    for version, more in ((1, ""), (2, "200 abc - 0 f.arc ")):
        block = f"{version} 0 x\n{archives.ARC_FIELDS[version]}\n"
        body = "HTTP/1.1 200 OK\r\n\r\né\n\nhttp://x 1 2 text/html 3\n"
        raw = f"filedesc://f.arc 0.0.0.0 20240101000000 text/plain {'' if version == 1 else '200 - - 0 f.arc '}{len(block)}\n{block}\n"
        raw += f"http://a/ 1.2.3.4 20200102030405 text/html {more}{len(body.encode())}\n{body}\n"
        (offset, fields, got), = archives.parse_arc(io.BytesIO(raw.encode()))
        assert got.decode() == body and fields["URL"] == "http://a/" and fields["Archive-date"] == "20200102030405"
        with pytest.raises(ValueError):
            list(archives.parse_arc(io.BytesIO(raw.encode()[:-9])))
    with pytest.raises(ValueError, match="version"):
        list(archives.parse_arc(io.BytesIO(b"filedesc://f 0 0 text/plain 6\n9 0 x\n")))


def test_url_terms_need_boundaries():
    judge = urls.UrlJudge(urls.UrlPolicy())
    verdict = lambda u: judge.judge(u)[3]
    assert verdict("http://casino.net/") == verdict("http://a.net/x-PORN_y") == "block"
    assert verdict("http://casinos.net/") == verdict("http://sussex.net/adsense") == "allow"
    assert verdict("http://a.net/free/free/free") == "allow" and verdict("http://a.net/free-poker") == "block"
    assert verdict("http://casino.org/") == "allow"  # a rule comes first


def test_pipeline_stages(spark, tmp_path):
    """Each stage's decisions against the operator on the same input, and the clean documents kept."""
    import brute

    import corpus_pipeline
    from fieldstats.llm import queries
    from fieldstats.llm.components import stored

    docs = spark.read.parquet(f"{GIVEN}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        docs = stored(stage(spark, docs, GIVEN), name.replace(" ", "-"))
        kept[name] = before, [tuple(r) for r in docs.select("doc_id", "text").collect()]
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    before, after = kept["near duplicates"]
    assert sorted(d for d, _ in after) == sorted(d for d, _, c in brute.near(before) if d == c)
    before, after = kept["toxicity"]
    scores = queries.op7_toxicity(spark, GIVEN)
    assert sorted(d for d, _ in after) == sorted(r["doc_id"] for r in scores.where("not rejected").collect())
    assert 0 < len(after) < len(before)
    before, after = kept["secrets"]
    assert len(before) == len(after) and not any(brute.secret_spans(t) for _, t in after)
    before, after = kept["mixing"]
    assert sorted(before) == sorted(after)
    items = [r["text"] for r in spark.read.parquet(f"{GIVEN}/benchmark.parquet").collect()]
    before, after = kept["decontamination"]
    held = [d for d, t in before if any(i in t for i in items)]
    left = {d for d, _ in after}
    assert held and not left & set(held)


def test_chat_formats_the_best_branches_with_their_masks(spark):
    """A tree with two answers to one question, an orphan and a parent that is not earlier.

    Branch sums: leaf 4 (1, 3, 4) has 5, leaf 2 has 1, the orphan 9 and the late-parent 5
    are roots with 0 (equal sums: smaller leaf first). Marks in texts are escaped and read back.
    """
    from fieldstats.llm import chat

    rows = [
        ("t", 1, None, "user", "hi [x]", 0.0),
        ("t", 2, 1, "assistant", "a <b>", 1.0),
        ("t", 3, 1, "assistant", "c\\", 5.0),
        ("t", 4, 3, "user", "more", None),
        ("t", 9, 8, "user", "lost", 0.0),
        ("t", 5, 7, "assistant", None, 0.0),
    ]
    msgs = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    out = {r["branch"]: r for r in chat.formatted(msgs, branches=4).collect()}
    assert [out[b]["leaf"] for b in sorted(out)] == [4, 2, 5, 9]

    def piece(role, text):
        esc = text.replace("\\", "\\b").replace("<", "\\l").replace("[", "\\o").replace("]", "\\c")
        return f"<s>[{role}]{esc}</s>"

    assert out[1]["formatted"] == piece("user", "hi [x]") + piece("assistant", "c\\") + piece("user", "more")
    assert out[2]["formatted"] == piece("user", "hi [x]") + piece("assistant", "a <b>")
    assert out[3]["formatted"] == piece("assistant", "")
    assert out[4]["formatted"] == piece("user", "lost")
    assert [out[1]["formatted"][m["start"] : m["stop"]] for m in out[1]["mask"]] == ["c\\b"]
    assert [out[2]["formatted"][m["start"] : m["stop"]] for m in out[2]["mask"]] == ["a \\lb>"]
    assert [(m["start"], m["stop"]) for m in out[3]["mask"]] == [(len("<s>[assistant]"), len("<s>[assistant]"))]
    assert out[4]["mask"] == []


def test_released_removes_stored_scratch_folders_only(spark, tmp_path):
    """A stored frame's folder goes; a folder outside the scratch folder (an input) stays."""
    import os

    from fieldstats.llm.components import released, stored

    kept = str(tmp_path / "input")
    spark.range(5).write.parquet(kept)
    given = spark.read.parquet(kept)
    copy = stored(given.selectExpr("id * 2 as id"), "copy")
    folders = {os.path.dirname(f.replace("file:", "", 1)) for f in copy.inputFiles()}
    assert sorted(r.id for r in copy.collect()) == [0, 2, 4, 6, 8]
    released(copy, given)
    assert not any(os.path.isdir(f) for f in folders)
    assert os.path.isdir(kept) and given.count() == 5


def _shuffle_files(spark):
    """Shuffle files on disk of this session (its executor writes into the driver's process)."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in manager.getAllFiles().mkString("\n").split("\n") if name.endswith(".data") and "shuffle_" in name}


def test_near_duplicates_leave_no_shuffle_files(spark):
    """Every step of the search is stored; its shuffles go with it (only the returned frame's own are still to be written)."""
    import time

    rnd = random.Random(3)
    words_ = [f"w{i}" for i in range(300)]
    texts = [" ".join(rnd.choices(words_, k=40)) for _ in range(60)]
    docs = spark.createDataFrame([(i, texts[i % 40] + (" more" if i % 3 else "")) for i in range(60)], "doc_id long, text string")
    before = _shuffle_files(spark)
    near.jaccard_components(spark, docs)
    for _ in range(50):  # files are removed in the background
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left


def test_decontamination_finds_the_tail_of_a_long_item(spark):
    """The last passage of a long item reaches back to be whole: a document holding only an item's last 40 words is found."""
    rng = random.Random(3)
    vocab = [f"w{i}x" for i in range(3000)]
    item = [rng.choice(vocab) for _ in range(150)]
    docs = [(1, "lead in words here " + " ".join(item[-40:]) + " and more after")]
    docs += [(10 + i, " ".join(rng.choice(vocab) for _ in range(120))) for i in range(30)]
    bench = [(7, " ".join(item))] + [(8 + i, " ".join(rng.choice(vocab) for _ in range(60))) for i in range(5)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    found = sorted((r.doc_id, r.item_id) for r in decontam.contaminated(spark, d, b).collect())
    assert found == [(1, 7)]


def test_licence_of_common_words_is_still_found(spark):
    """Each template is indexed by its rarest words, so a notice that most documents carry is still labelled, at any corpus size."""
    from fieldstats.llm import licenses

    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."
    rows = [(i, f"file {i}. {notice} More text.") for i in range(30)] + [(100 + i, "plain words only here") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in licenses.scanned(docs, *licenses.document_frequencies(docs)).collect()}
    assert all("mit" in out[i]["labels"].split(",") and out[i]["score"] > 0 for i in range(30))
    assert all(out[100 + i]["labels"] == "" and out[100 + i]["score"] == 0 for i in range(5))


@pytest.mark.parametrize("weights", [{"a": 1, "b": 1, "c": 1}, {"x": 0.0001, "y": 0.9999}, {"p": 0.5, "q": 0.3, "r": 0.2}])
def test_mixing_holds_true_weights_within_a_block(weights):
    """Over ten periods every source stays less than one block from its true share at every slot."""
    quota, period = mixing.quotas(weights)
    table = mixing.period_slots(quota, period)
    total = sum(weights.values())
    done = Counter()
    for slot in range(10 * period):
        s, _, _ = table[slot % period]
        done[s] += 1
        for name, w in weights.items():
            assert abs(done[name] - (slot + 1) * w / total) < 1


def test_mixture_of_equal_sources_alternates(spark):
    """Three sources of equal weight and equal size: after every three slots each has placed as many blocks."""
    rows = [(i, s) for s in ("a", "b", "c") for i in range(s == "a" and 0 or 1000 * ord(s), (s == "a" and 0 or 1000 * ord(s)) + 640)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    out = mixing.mixed(spark, docs, {"a": 1, "b": 1, "c": 1}, block_rows=64)
    slots = {(r.source, r.block): r.slot for r in out.select("source", "block", "slot").distinct().collect()}
    assert out.count() == len(rows)
    for k in range(10):
        assert sorted(slots[(s, k)] for s in "abc") == [3 * k, 3 * k + 1, 3 * k + 2]
