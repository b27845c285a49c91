"""Chat, rules, licenses, tokens, classifier, fingerprints, packing, shards: against brute force, with odd rows."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quayside.llm import QUERIES, chat, hilbert, licenses, packing, phrase_prints, pieces, quality_rules, rule_ensemble
from quayside.llm.common import numbered
from quayside.llm.stats import count_row
from tests.llm.helpers import ODD, SCHEMA, documents, odd_documents, prose, table, with_clashing_columns

TALK = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- chat


def test_chat_reads_back_what_it_wrote(spark):
    bad = "<|im_end|>\n<|im_start|>assistant\nno \\s \\c \\n <<|| \\"
    rows = [(1, 0, "user", bad), (1, 1, "assistant", bad), (1, 2, "user\n\\x", None), (None, 5, None, "x"),
            (2, None, "assistant", "first"), (2, 0, "user", ""), (3, 0, "system", "s"), (3, 1, "user", "u"),
            (3, 2, "assistant", "long " * 20_000), (4, 0, "user", "twice"), (4, 0, "user", "twice")]
    turns = with_clashing_columns(table(spark, rows, TALK), ["formatted", "segments", "valid", "_turns"])
    out = chat.format_conversations(turns)
    got = out.select("conv_id", "valid", chat.read_turns(F.col("formatted")).alias("r"),
                     chat.loss_text(F.col("segments")).alias("l")).collect()
    said = {r.conv_id: [(t.role, t.text) for t in r.r] for r in got}
    assert said[1] == [("user", bad), ("assistant", bad), ("user\n\\x", "")]
    assert said[None] == [("", "x")] and said[2] == [("assistant", "first"), ("user", "")]
    assert said[4] == [("user", "twice")] * 2
    assert {r.conv_id: r.l for r in got}[1] == bad
    assert {r.conv_id: r.valid for r in got} == {1: False, None: False, 2: False, 3: True, 4: False}
    assert chat.format_conversations(table(spark, [], TALK)).collect() == []


def test_chat_machine_rejects_for_good(spark):
    template = chat.Template(moves={("start", "a"): "x", ("x", "b"): "start"}, accepting=("start",))
    rows = [(1, i, r, "") for i, r in enumerate("abab")] + [(2, i, r, "") for i, r in enumerate("bab")]
    out = chat.format_conversations(table(spark, rows, TALK), template)
    assert {r.conv_id: r.valid for r in out.collect()} == {1: True, 2: False}


# ---- quality rules


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) for j in range(5) if grams[tuple(words[i:i + 5])] > 1}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered))


def test_counts_are_those_of_brute_force():
    texts = [*ODD, "a b c d e f a b c d e f a b", "# $ | < >", "x\nx\n \n\ny\nx", "\x1c a\x85b　c", "w " * 50]
    for text in texts:
        assert count_row(text) == brute_counts(text), text


def labelled(spark, n=60):
    good = [prose(30 + i % 17, i) for i in range(n)]
    bad = [" ".join(w + "###" for w in prose(30, i).split()) for i in range(n // 3)]
    texts = good + bad
    labels = [(i, int(i < n), 0) for i in range(len(texts)) if i % 2] + [(None, 1, 0), (1, None, 0), (3, 1, 0)]
    return documents(spark, texts), table(spark, labels, "doc_id long, quality int, toxic int"), n


def test_rules_reject_the_odd_and_keep_the_clean(spark):
    docs, labels, n = labelled(spark)
    rules = quality_rules.fit_quality_rules(docs, labels)
    kept = {r.doc_id: r.rules.kept for r in quality_rules.judge_documents(docs, rules).collect()}
    assert all(kept[i] == (i < n) for i in kept)
    odd = with_clashing_columns(odd_documents(spark), ["rules", "kept"])
    rows = quality_rules.judge_documents(odd, rules).collect()
    assert len(rows) == odd.count() and not any(r.rules.kept for r in rows if not (r.text or "").strip())
    none = quality_rules.fit_quality_rules(docs, labels.limit(0))
    assert none.forest is None
    got = quality_rules.judge_documents(docs, none).select("rules.base_failed", "rules.kept").collect()
    assert all(r.kept is not r.base_failed for r in got)
    assert quality_rules.judge_documents(table(spark, [], SCHEMA), rules).collect() == []


def test_forest_scores_are_mean_path_lengths():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    forest = quality_rules.fit_isolation_forest(x, x.min(0), x.max(0), trees=20, tree_rows=64)

    def depth(t, row):
        at = 0
        while forest.column[t, at] >= 0:
            at = forest.left[t, at] if row[forest.column[t, at]] < forest.cut[t, at] else forest.right[t, at]
        return forest.depth[t, at]

    want = [2 ** (-np.mean([depth(t, row) for t in range(20)]) / quality_rules.expected_depth(64)) for row in x[:40]]
    assert np.allclose(forest.scores(x[:40]), want)
    assert forest.scores(np.array([[9.0, 9.0, 9.0]]))[0] > np.median(forest.scores(x))


# ---- rule ensemble


def test_rule_ensemble_learns_and_compiles(spark):
    docs, labels, n = labelled(spark)
    model = rule_ensemble.fit_rule_ensemble(docs, labels)
    assert model.rules
    got = {r.doc_id: r for r in rule_ensemble.score_documents(docs, model).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == int(i < n) == int(r.score >= 0.5) for i, r in got.items())
    # The column is the same sum as by hand.
    from quayside.llm.stats import SHARES, share_row
    for i in (0, 1, n + 1):
        text = got[i].text
        s = dict(zip(SHARES, share_row(text, count_row(text))))
        total = model.intercept + sum(w for rule, w in model.rules
                                      if all(s[c] <= v if sign == "<=" else s[c] > v for c, sign, v in rule))
        assert got[i].score == pytest.approx(1 / (1 + np.exp(-total)))
    odd = with_clashing_columns(odd_documents(spark), ["score", "predicted", "n_words", "_s"])
    assert rule_ensemble.score_documents(odd, model).count() == odd.count()
    assert rule_ensemble.fit_rule_ensemble(docs, labels.limit(0)).rules == ()
    assert rule_ensemble.score_documents(table(spark, [], SCHEMA), model).collect() == []


def test_rule_ensemble_on_held_out_rows(spark, folder):
    out = QUERIES["op7_rule_ensemble"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").dropna(subset=["quality"])
    held = out.filter("held_out").join(labels, "doc_id").collect()
    assert len(held) > 50
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.93
    assert sum(r.predicted for r in held if r.quality == 1) / sum(r.quality for r in held) > 0.98


def test_rules_keep_labelled_clean_documents(spark, folder):
    out = QUERIES["op2_quality_rules"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").dropna(subset=["quality"])
    rows = out.join(labels, "doc_id").filter("not base_failed").collect()
    assert sum(r.kept for r in rows if r.quality == 1) / sum(r.quality for r in rows) > 0.99
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(bad) / len(bad) < 0.2
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in out.limit(200).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(texts[r.doc_id])


def test_forest_sees_every_statistic(spark, folder):
    """Repeated short lines between unique ones, floods of digits, encoded words, one word in every second place."""
    words = prose(400).split()
    texts = ["\n".join(x for i in range(100) for x in (" ".join(words[i * 3:i * 3 + 4]), "read more")),
             " ".join(str(10**9 + i * 7919 * 104729) for i in range(300)),
             " ".join(base64.b64encode(np.random.default_rng(i).bytes(60)).decode() for i in range(200)),
             " ".join(x for w in words for x in (w, "buy"))]
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    rules = quality_rules.fit_quality_rules(docs, labels)
    rows = quality_rules.judge_documents(documents(spark, texts), rules).select("rules.*").collect()
    assert not any(r.base_failed for r in rows) and not any(r.kept for r in rows)


# ---- licenses


def brute_licenses(text, phrases=licenses.PHRASES, templates=licenses.TEMPLATES):
    """By the rule: every window of every template, one after the other."""
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, base, more, best = [], set(), set(), 0.0
    for phrase, label in phrases:
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    for template, label, required in templates:
        t, must, n = set(template.split()), set(required.split()), len(template.split())
        others = [set(r.split()) for _, _, r in templates]
        barred = set().union(*[o - must for o in others if must < o])
        width = n + max(2, -(-n // 4))
        for i in range(len(words)):
            block = set(words[i:i + width])
            if must <= block and not barred & block and 5 * len(block & t) >= 4 * len(t):
                more |= {label}
                best = max(best, len(block & t) / len(t))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | more)), 1.0 if base else best)


MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of\n * this software and associated "
       "documentation files (the \"Software\"), to deal")
BSD = ("Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that "
       "the following conditions are met:")
GPL = ("This program is free software: you can redistribute it and/or modify it under the\nterms of the GNU General "
       "Public License as published by the Free Software Foundation")


def test_license_join_is_exact(spark):
    scattered = prose(160).split()
    for i, w in enumerate("Licensed under CC BY 4 0".split()):
        scattered[i * 25] = w
    labels = {
        "MIT LICENSE mit license": "mit", "license mit": "", "released\nunder\nthe\nmit\nlicense": "mit",
        "Licensed under CC BY 4.0.": "cc-by", "Licensed under CC BY-NC 4.0.": "cc-by-nc", "licensed under by nc 4": "",
        "licensed under CC-BY-SA 4.0": "cc-by-sa", "Licensed under CC BY-NC-SA 4.0": "cc-by-nc-sa",
        "Licensed under CC BY-ND 4.0": "cc-by-nd", "Licensed under CC BY-NC-ND 4.0": "cc-by-nc-nd",
        "Licensed under CC BY 4.0. " + prose(30) + " Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc",
        "Released under the BSD 3-Clause License": "bsd", "Released under the MIT License": "mit",
        " ".join(scattered): "", "work licensed under gnu general public license version 3": "gpl",
        MIT: "mit", prose(90) + "\n" + BSD + prose(90): "bsd", GPL: "gpl", "Apache, License": "apache", "": "",
        "permit licensed\nReleased under MIT terms, the License!": "mit", "mit liçense": "", "Kelvin K mit license": "mit"}
    texts = [*labels, None, *ODD]
    rows = {r.doc_id: r for r in licenses.scan_licenses(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels,
                r.score) == brute_licenses(text), text
        assert (r.score > 0) == bool(r.labels)
        assert r.labels == labels.get(text, r.labels), text
    mine = ["_hit", "_words", "_base", "_met", "row", "at", "label"]
    odd = with_clashing_columns(odd_documents(spark), ["labels", *mine])
    found = licenses.scan_licenses(odd).collect()
    assert len(found) == odd.count() and all(r[c] == "clash" for r in found for c in mine)
    assert not any(r.labels == "clash" for r in found)
    assert licenses.scan_licenses(documents(spark, texts), phrases=(), templates=()).filter("labels != ''").count() == 0
    assert licenses.scan_licenses(table(spark, [], SCHEMA)).collect() == []


def test_license_labels_of_all_test_documents(spark, folder):
    """The rule by brute force over the documents that hold a word of a notice."""
    rows = QUERIES["op4_license_scan"](spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        if r.labels or re.search("licen|permi|redist|rights", texts[r.doc_id] or "", re.I):
            assert r[1:] == brute_licenses(texts[r.doc_id])


def test_wrapped_notices_are_met(spark):
    mpl = ("This Source Code Form is subject to the terms of the Mozilla Public\n{}License, v. 2.0. If a copy of the MPL\n"
           "{}was not distributed with this file, You can obtain one.")
    texts = [mpl.format("", ""), prose(300) + "\n// " + mpl.format("// ", "// ") + "\n" + prose(300, 5),
             "All rights reserved.\nNo part of this\npublication may be reproduced", "Released under\n# the BSD 3-clause\n# license",
             "Licensed under\nCC BY 4.0", "Licensed under CC\n" + prose(20) + "\nBY 4.0", prose(900)]
    rows = {r.doc_id: r for r in licenses.scan_licenses(documents(spark, texts)).collect()}
    assert [rows[i].labels for i in range(3)] == ["mpl", "mpl", "all-rights-reserved"]
    assert [rows[i].labels for i in (3, 4)] == ["bsd", "cc-by"]
    assert [rows[i].score for i in range(5)] == [1.0] * 5
    assert [(rows[i].labels, rows[i].score) for i in (5, 6)] == [("", 0.0)] * 2


# ---- pieces and packing


PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_pieces_are_the_library_s(spark):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    docs = with_clashing_columns(odd_documents(spark), ["ids", "decoded"])
    for r in docs.select("text").join(pieces.encode_documents(docs, PIECE_MODEL).groupBy("ids", "decoded").count(),
                                      F.lit(True)).limit(0).collect():
        raise AssertionError(r)
    got = Counter((tuple(r.ids), r.decoded) for r in pieces.encode_documents(docs, PIECE_MODEL).collect())
    want = Counter((tuple(x), model.decode(x)) for x in (model.encode(r.text or "") for r in docs.collect()))
    assert got == want
    digests = pieces.digest_documents(docs, PIECE_MODEL).collect()
    assert Counter(r.ids_sha256 for r in digests) == Counter(
        hashlib.sha256(",".join(map(str, model.encode(r.text or ""))).encode()).hexdigest() for r in docs.collect())
    assert pieces.digest_documents(table(spark, [], SCHEMA), PIECE_MODEL).collect() == []


def test_piece_table_is_bounded():
    small = pieces.ChunkTable(PIECE_MODEL, most=50)
    whole = pieces.ChunkTable(PIECE_MODEL)
    texts = [prose(200, i) for i in range(5)] + [t or "" for t in ODD]
    assert list(small.encode(texts)) == list(whole.encode(texts))
    assert [ids for _, ids in whole.encode(texts)] == [whole.model.encode(t) for t in texts]


def test_pieces_of_all_test_documents(spark, folder):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    got = {r.doc_id: r for r in QUERIES["op5_pieces"](spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = model.encode(r.text or "")
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()


VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def check_packing(spark, docs, out, width):
    from tokenizers import Tokenizer
    coder = Tokenizer.from_file(VOCABULARY)
    want = Counter()
    for r in docs:
        ids = np.array([*coder.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % width or width
        cuts = [0, *range(first, len(ids), width), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= width
    return len(sequences), -(-sum(r.length for r in out) // width)


def test_packing_of_all_test_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    used, bound = check_packing(spark, docs, QUERIES["op8_packing"](spark, folder).collect(), 1024)
    assert used <= bound * 1.01 + 1


def test_packing_of_odd_rows(spark):
    docs = with_clashing_columns(odd_documents(spark), ["sequence_id", "offset"])
    mine = ["_n", "_number", "_place", "_block", "row", "key", "number", "place", "hash"]
    cut = with_clashing_columns(packing.cut_pieces(docs, VOCABULARY, width=16), ["offset", *mine])
    out = packing.pack_pieces(cut, width=16, block_rows=7).collect()
    assert all(r[c] == "clash" for r in out for c in mine)
    check_packing(spark, docs.collect(), out, 16)
    none = packing.cut_pieces(table(spark, [], SCHEMA), VOCABULARY)
    assert packing.pack_pieces(none).collect() == []


def test_recipes_use_every_length_once():
    rng = np.random.default_rng(3)
    for n, width in ((0, 8), (1, 8), (40, 16), (500, 64), (5000, 1024)):
        counts = Counter(rng.integers(1, width + 1, n).tolist())
        recipes, used = packing.plan_recipes(counts, width), Counter()
        for parts, times in recipes:
            assert sum(parts) <= width and times > 0
            for p in parts:
                used[p] += times
        assert used == counts
    # Singles, pairs and triples that fill a gap exactly are found.
    assert sum(t for _, t in packing.plan_recipes({10: 2, 6: 3, 4: 3, 3: 2, 5: 2, 2: 2}, 10)) == 7  # 70 / 10, the fewest


def test_plans_use_pairs_and_triples(spark, folder):
    """The plan has sums of pairs and triples and is not longer than best-fit alone."""
    cut = packing.cut_pieces(spark.read.parquet(f"{folder}/documents.parquet"), VOCABULARY)
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    recipes = packing.plan_recipes(counts, 1024)
    exact = Counter()
    for parts, times in recipes:
        exact[len(parts)] += times * (sum(parts) == 1024)
    assert exact[2] and exact[3]
    assert sum(t for _, t in recipes) <= sum(t for _, t in packing.best_fit(counts, 1024))
    assert packing.plan_recipes({7: 2, 2: 2, 1: 2}, 10) == [((7, 2, 1), 2)]
    triple, = packing.plan_recipes({49: 3, 23: 3, 18: 3, 10: 3}, 100)
    assert triple == ((49, 23, 18, 10), 3)


# ---- fingerprints


def brute_phrases(data: bytes) -> set[bytes]:
    found, begin = set(), 0
    for end in range(1, len(data) + 1):
        if data[begin:end] not in found:
            found.add(data[begin:end])
            begin = end
    return found


def test_phrases_and_resumed_parses():
    for text in [t or "" for t in ODD] + ["abababababab", "aaaaaaaaaa"]:
        data = text.encode()
        whole = phrase_prints.Parse().read(data, 0)
        assert set(whole.phrases) == brute_phrases(data) and len(whole.phrases) == len(set(whole.phrases))
        cut = len(data) // 3
        first = phrase_prints.Parse().read(data[:cut], 0)
        again = first.copy().read(data, cut)
        assert again.phrases == whole.phrases
        assert first.phrases == phrase_prints.Parse().read(data[:cut], 0).phrases


def brute_neighbours(rows):
    low = float("-inf")
    rows = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else low), r[1] or ""))
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        yield (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), phrase_prints.fingerprint(text),
               phrase_prints.fingerprint(edited), after)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_neighbours_across_blocks(spark, parts):
    docs = with_clashing_columns(odd_documents(spark), ["block", "guest", "host", "fingerprint"])
    out = phrase_prints.compare_neighbours(docs, parts=parts).collect()
    want = Counter(x[:5] for x in brute_neighbours([(r.doc_id, r.text) for r in docs.collect()]))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in out) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)


def test_neighbours_of_few_rows(spark):
    assert phrase_prints.compare_neighbours(table(spark, [], SCHEMA)).collect() == []
    one, = phrase_prints.compare_neighbours(documents(spark, ["some text"])).collect()
    assert one.near_next == 1.0


def test_fingerprints_tell_likeness(spark, folder):
    out = QUERIES["op9_phrase_prints"](spark, folder).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = {x[0]: x for x in brute_neighbours(docs)}
    assert len(out) == len(docs)
    errors, texts = [], dict(docs)
    for r in out:
        assert (r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == want[r.doc_id][:5]
        if r.doc_id % 10 == 0:
            a, b = (brute_phrases((t or "").encode()) for t in (texts[r.doc_id], want[r.doc_id][5]))
            errors.append(abs(r.near_next - (len(a & b) / len(a | b) if a | b else 1.0)))
    assert np.mean(errors) < 0.05
    long = [r for r in out if r.n_chars > 400]
    assert sum(r.near_edited > r.near_next for r in long) > 0.9 * len(long)


# ---- shards


def test_curve_visits_neighbours(spark):
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        df = spark.range(1 << (dims * bits)).select(
            *[F.expr(f"(id >> {bits * i}) & {(1 << bits) - 1}").cast("int").alias(f"c{i}") for i in range(dims)])
        out = df.withColumn("at", hilbert.curve_index([F.col(f"c{i}") for i in range(dims)], bits)).collect()
        path = sorted(out, key=lambda r: r["at"])
        assert [r["at"] for r in path] == list(range(len(path)))
        assert all(sum(abs(a[f"c{i}"] - b[f"c{i}"]) for i in range(dims)) == 1 for a, b in zip(path, path[1:]))


def check_shards(rows, shards):
    counts = Counter(r.shard for r in rows)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def test_shards_of_odd_rows(spark):
    docs = with_clashing_columns(odd_documents(spark), ["curve", "shard", "slot", "_n", "_block"]).drop("_n", "_block")
    out = hilbert.hilbert_shards(docs, ["lang", "doc_id"], 5, ["doc_id", "text"], block_rows=3).collect()
    check_shards(out, 5)
    assert hilbert.hilbert_shards(table(spark, [], SCHEMA), ["lang", "doc_id"], 5, ["doc_id"]).collect() == []
    by_curve = sorted(out, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in by_curve] == sorted(r.curve for r in out)


def test_shards_of_all_test_documents(spark, folder):
    rows = QUERIES["op10_hilbert_shards"](spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    check_shards(rows, 24)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))


def test_shards_prune_files(spark, folder, tmp_path):
    """A filter on any of the columns meets fewer shards than in a random order."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "source", "n_chars")
    out = hilbert.hilbert_shards(docs, ["source", "lang", "n_chars"], 24, ["doc_id"])
    path = str(tmp_path / "shards")
    hilbert.write_shards(out, path)
    back = spark.read.parquet(path)
    assert back.count() == docs.count()
    spans = back.groupBy("shard").agg(F.min("source").alias("a"), F.max("source").alias("b")).collect()
    assert sum(r.a <= "src7" <= r.b for r in spans) < 20


def test_texts_with_a_common_prefix_have_their_own_cells(spark):
    rows = [(i, f"https://host-{i * 7 % 40:02d}.example/", "en", None) for i in range(400)]
    docs = table(spark, rows, "doc_id long, source string, lang string, size long")
    assert [bytes(c) for c in sorted(hilbert.text_cuts(docs, "source", 4))] == [
        f"https://host-{k:02d}.example/".encode() for k in (9, 19, 29)]
    out = hilbert.hilbert_shards(docs, ["source"], 10, ["doc_id"]).collect()
    check_shards(out, 10)
    places = {}
    for r in out:
        places.setdefault(r.source, set()).add(r.curve)
    in_order = [places[s] for s in sorted(places)]
    assert all(len(p) == 1 for p in in_order) and len(set().union(*in_order)) == 16
    assert [min(p) for p in in_order] == sorted(min(p) for p in in_order)
    of_source = {s: {r.shard for r in out if r.source == s} for s in places}
    assert max(map(len, of_source.values())) <= 2
    nulls = table(spark, [(i, None if i < 90 else "a" * 8 + str(i), "en", None) for i in range(100)],
                  "doc_id long, source string, lang string, size long")
    cells = hilbert.with_curve(nulls, ["source"]).collect()
    assert {r.curve for r in cells if r.source is None} == {0} and min(r.curve for r in cells if r.source) > 0


def test_numbers_are_gapless_in_hot_groups(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("k"), "id",
                                  F.lit(1).alias("same"), F.lit(77).alias("_n"), F.lit(78).alias("block"),
                                  F.lit(79).alias("number"), F.lit(80).alias("key"), F.lit(81).alias("row"))
    sizes = df.groupBy("k").agg(F.count(F.lit(1)).alias("_n"))
    for ties in (["id"], ["same"]):
        out = numbered(df, "k", sizes, ties, "number", block_rows=50).collect()
        assert all((r._n, r.block, r.key, r.row) == (77, 78, 80, 81) for r in out)
        for k in {r.k for r in out}:
            found = sorted(r.number for r in out if r.k == k)
            assert found == list(range(len(found)))
