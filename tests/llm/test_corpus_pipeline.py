"""The five stages on planted documents."""

import random
from collections import defaultdict

import pytest

import corpus_pipeline as C
from seriesforge.llm import decontaminate, near_dup, packing
from seriesforge.llm.common import read_table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Clean prose, junk, copies, benchmark passages and personal data, with
    nulls, empty texts, repeated rows and clashing extra columns."""
    rng = random.Random(11)
    vocabulary = [f"{a}{b}{c}" for a in ("ba", "do", "ki", "lu", "me") for b in ("ran", "ti", "so", "va") for c in ("", "s", "lo", "ne")]
    prose = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ","]) for _ in range(n)) + "."
    items = [(i, prose(30)) for i in range(5)]
    docs, labels = {}, []
    for i in range(300):
        junk = i % 5 == 0
        docs[i] = " ".join(w.upper() + "###" for w in prose(80).split()) if junk else prose(120)
        labels.append((i, 0 if junk else 1))
    clean = [i for i in docs if i % 5]
    docs |= {1001: docs[1], 1002: docs[2].replace(docs[2].split()[60], "changed", 1)}
    docs |= {1003: prose(60) + " " + items[3][1] + " " + prose(60), 1004: items[0][1], 1005: prose(100) + " mail joe.doe@site.org or +1 (640) 555-0953 now"}
    docs |= {1006: None, 1007: "", 1008: prose(9000), 1009: prose(40)}
    rows = [(i, t, "en", "s", len(t) if t else 0, True, 1) for i, t in docs.items()] + [(1009, docs[1009], "en", "s", 7, True, 1), (None, prose(90), None, None, None, None, None)]
    folder = str(tmp_path_factory.mktemp("planted"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, length int").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs, clean, items


def test_stages(spark, planted):
    folder, docs, clean, items = planted
    frame = read_table(spark, folder, "documents")
    columns, out = frame.columns, {}
    for name, stage in C.STAGES[:-1]:
        frame = spark.createDataFrame(stage(spark, frame, folder).collect(), frame.schema)
        assert frame.columns == columns
        out[name] = defaultdict(list)
        for r in frame.collect():
            out[name][r.doc_id].append(r)
    kept = out["quality_rules"]
    assert set(clean) <= set(kept) and not {i for i in range(300) if i % 5 == 0} & set(kept)
    assert not {1006, 1007} & set(kept) and {1001, 1002, 1003, 1005, 1008, None} <= set(kept) and len(kept[1009]) == 2
    kept = out["minhash_near_dup"]
    assert set(clean) <= set(kept) and not {1001, 1002} & set(kept) and {1003, 1005, None} <= set(kept)
    kept = out["benchmark_decontamination"]
    assert set(clean) <= set(kept) and 1004 not in kept and all(kept[i][0].text == docs[i] for i in clean)
    assert items[3][1] not in kept[1003][0].text and kept[1003][0].n_chars == len(kept[1003][0].text) > 300
    kept = out["personal_data"]
    assert set(clean) <= set(kept) and all(kept[i][0].text == docs[i] for i in clean)
    assert kept[1005][0].text.endswith("mail <EMAIL> or <PHONE> now")
    last = C.STAGES[-1][1](spark, frame, folder).collect()
    assert {r.doc_id for r in last} == set(kept)


def test_run_equals_its_parts(spark):
    """All rows of the packing are of documents that every stage keeps by brute force on its own input."""
    out = C.run(spark, SF).collect()
    from test_packing import check
    docs = read_table(spark, SF, "documents")
    texts = {}
    frame = docs
    for _, stage in C.STAGES[:-1]:
        frame = stage(spark, frame, SF)
    texts = [(r.doc_id, r.text) for r in frame.collect()]
    from tokenizers import Tokenizer
    check(texts, out, Tokenizer.from_file(packing.public_tokenizer()))
    # nothing is left of what the stages look for
    left = spark.createDataFrame(frame.collect(), frame.schema)
    assert all(not r.contaminated for r in decontaminate.contamination(left, read_table(spark, SF, "benchmark")).collect())
    assert len(texts) > 700 and near_dup.PERCENT == 85


def test_empty_documents(spark, planted):
    folder = planted[0]
    frame = read_table(spark, folder, "documents").limit(0)
    for _, stage in C.STAGES:
        frame = stage(spark, frame, folder)
        assert frame.collect() == []
