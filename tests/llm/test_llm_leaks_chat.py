"""Decontamination, chat formatting, the pipeline and the registry."""

import os
import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF001, SF01
from tidecast.llm import chat, decontaminate, pii, quality, simhash


# ---- decontamination ------------------------------------------------------------------

def slow_align(item, region):
    h = np.zeros((len(item) + 1, len(region) + 1))
    for i, a in enumerate(item):
        for j, b in enumerate(region):
            h[i + 1, j + 1] = max(0, h[i, j] + (1 if a == b and a else -0.5), h[i, j + 1] - 0.5, h[i + 1, j] - 0.5)
    return h.max()


def test_alignment_equals_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        item = np.array([rng.randint(1, 6) for _ in range(rng.randint(1, 12))])
        region = np.array([rng.randint(0, 6) for _ in range(rng.randint(1, 20))])
        score, first, end = decontaminate.align(item, region)
        assert score == pytest.approx(slow_align(item, region))
        assert not score or slow_align(item, region[first:end]) == pytest.approx(score)


def leaks(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted((r.doc_id, r.item_id, round(r.score, 3), r.first_word, r.end_word) for r in decontaminate.find_leaks(d, b, **options).collect())


def words(rng, n):
    return [rng.choice("abcdefghij") + str(rng.randint(0, 400)) for _ in range(n)]


def test_edited_copies_are_found_and_clean_texts_are_not(spark):
    rng = random.Random(9)
    items = [(k, words(rng, rng.randint(16, 60))) for k in range(40)]
    docs, planted = [], set()
    for i in range(200):
        body = words(rng, rng.randint(0, 300))
        if i % 2:
            k, item = rng.choice(items)
            copy = [w if rng.random() > 0.1 else "edited" for w in item if rng.random() > 0.03]
            at = rng.randint(0, len(body))
            body[at:at] = copy
            planted.add((i, k))
        docs.append((i, " ".join(body)))
    found = leaks(spark, docs, [(k, " ".join(w)) for k, w in items], block_chars=2000)
    assert len(planted - {(d, k) for d, k, *_ in found}) <= 2 and {(d, k) for d, k, *_ in found} <= planted
    assert found == leaks(spark, docs, [(k, " ".join(w)) for k, w in items])


def test_an_item_in_most_documents_is_found(spark):
    item = "who wrote the long letter that nobody in the small town ever read aloud"
    docs = [(i, f"some opening words {i} {item} and the end") for i in range(300)] + [(1000, "the small town that nobody in the long letter wrote")]
    assert [d for d, *_ in leaks(spark, docs, [(1, item), (2, "an item that is nowhere to be found in here")])] == list(range(300))


@pytest.mark.parametrize("times", [51, 5000])
def test_repeated_edited_and_partial_copies_equal_brute_force(spark, times):
    rng = random.Random(12)
    items = [(k, words(rng, 40)) for k in range(3)]
    edited = [f"edit{i}" if i % 5 == 4 else w for i, w in enumerate(items[0][1])]
    around = [(words(rng, 8), words(rng, 8)) for _ in range(5)]
    texts = [a + copy + b for copy in (edited, items[1][1][:21]) for a, b in around] + [a + items[2][1][:19] + b for a, b in around]
    number = {w: i + 1 for i, w in enumerate(sorted({w for _, t in items for w in t}))}
    coded = [[number.get(w, 0) for w in t] for t in texts]
    want = {(d, k): round(float(s) / 40, 3) for d, t in enumerate(coded) for k, item in items if (s := slow_align([number[w] for w in item], t)) >= 20}
    assert sorted(want) == [(d, int(d > 4)) for d in range(10)]
    docs = [(i * len(texts) + d, " ".join(t)) for i in range(-(-times // 5)) for d, t in enumerate(texts)]
    found = leaks(spark, docs, [(k, " ".join(t)) for k, t in items])
    assert [f[:3] for f in found] == [(i, k, want[i % len(texts), k]) for i, _ in docs for k in range(3) if (i % len(texts), k) in want]


def test_a_phrase_of_many_items_and_documents_loses_no_passage(spark):
    rng = random.Random(4)
    phrase = "which of the following is true".split()
    items = [(k, phrase + words(rng, 20)) for k in range(60)]
    docs = [(i, " ".join(words(rng, 30) + phrase + (items[i % 60][1][6:] if i % 3 == 0 else words(rng, 20)) + phrase)) for i in range(600)]
    assert [f[:2] for f in leaks(spark, docs, [(k, " ".join(t)) for k, t in items])] == [(i, i % 60) for i in range(0, 600, 3)]


def test_leaks_of_the_table(spark):
    docs, items = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()}
    flat = {r.item_id: " ".join(r.text.split()) for r in items.collect()}
    want = {(r.doc_id, k) for r in docs.collect() for k, t in flat.items() if t in " ".join(r.text.split())}
    assert want and got == want


def test_leak_edge_rows(spark):
    text = "What is the capital of the old country, and why?"
    docs = spark.createDataFrame([(1, None, "a", 1), (2, "", "a", 1), (3, text, "a", 1), (3, text, "a", 1), (3, "clean text", "b", 1), (None, text.upper(), "c", 1),
                                  (5, "w " * 30000 + text, "d", 1)], "doc_id long, text string, item_id string, score int")
    items = spark.createDataFrame([(1, text, 0), (1, text, 0), (2, text, 0), (None, text, 0), (3, None, 0), (4, "the", 0), (5, "", 0)], "item_id long, text string, doc_id int")
    got = sorted(((r.doc_id, r.item_id, r.score) for r in decontaminate.find_leaks(docs, items).collect()), key=str)
    assert got == sorted([(d, k, 1.0) for d in (3, 3, None, 5) for k in (1, 2)], key=str)
    kept = decontaminate.drop_leaks(docs, items)
    assert kept.columns == docs.columns and sorted((r.doc_id, r.text or "") for r in kept.collect()) == [(1, ""), (2, ""), (3, "clean text")]
    assert decontaminate.find_leaks(docs.where("false"), items).count() == 0 and decontaminate.find_leaks(docs, items.where("false")).count() == 0
    assert decontaminate.drop_leaks(docs, items.where("false")).count() == 7


# ---- chats ----------------------------------------------------------------------------

PIECES = ["\\", "### ", "</turn>", "\n", "a", ":", " ", "###", "<", "</turn>\n", "=", "User", "### Assistant: "]


def talk(rng, n):
    roles = ["user", "assistant", "system", "", "x: y", "a\\:b", "Assistant", "### z", "a:"]
    return [(rng.choice(roles), "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 8)))) for _ in range(n)]


def test_every_conversation_reads_back():
    rng = random.Random(1)
    for i in range(1500):
        turns = talk(rng, 70 if i % 50 == 0 else rng.randint(0, 5))
        r = chat.render(turns, chat.marked_turns)
        assert chat.read_turns(r.formatted) == turns and r.rewrites_at is None and r.opaque_at is None
        assert [chat.unescape(r.formatted[s[3]:s[4]]) for s in r.spans] == [t for _, t in turns]
        assert [chat.unescape(r.formatted[a:b]) for a, b in r.loss] == [t for role, t in turns if role == "assistant"]


def numbered(turns):
    return "<s>" + "".join(f"{i}:{t}\n" for i, (_, t) in enumerate(turns))


def strict(turns):
    if turns and turns[0][0] != "user":
        raise ValueError("a user starts")
    return "".join(f"[{r}]{t}" for r, t in turns)


def forgets(turns):
    return "".join((t if i >= len(turns) - 2 else "") + "|" for i, (_, t) in enumerate(turns))


def upper(turns):
    return "".join(f"<{t.upper()}>" for _, t in turns)


@pytest.mark.parametrize("template", [numbered, strict, chat.marked_turns])
def test_long_conversations_equal_whole_prefixes(template):
    turns = [("user" if i % 2 == 0 else "assistant", f"t{i}<") for i in range(90)]
    r = chat.render(turns, template)
    ends = [len(template(turns[:k + 1])) for k in range(90)]
    assert r.formatted == template(turns) and [s[2] for s in r.spans] == ends
    assert [r.formatted[a:b].replace("\\", "") for a, b in r.loss] == [t for role, t in turns if role == "assistant"]


def test_templates_that_rewrite_or_hide():
    turns = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    r = chat.render(turns, forgets)
    assert r.rewrites_at == 2 and r.spans == [] and r.loss == [] and r.formatted == forgets(turns)
    assert chat.render(turns * 20, forgets).rewrites_at == 2
    hidden = chat.render(turns, upper)
    assert hidden.opaque_at == 0 and hidden.loss == [] and len(hidden.spans) == 4


def test_chat_edge_rows(spark):
    rows = [(1, 1, "assistant", None, "x"), (1, 0, None, "q", "x"), (None, 0, "user", "n", "x"), (2, None, "user", "first", "x"), (2, 1, "user", "b", "x"),
            (2, 1, "user", "a", "x"), (2, 1, "user", "a", "x"), (3, 0, "assistant", "l" * 100000, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.format_chats(df).collect()}
    assert chat.read_turns(got[1].formatted) == [("", "q"), ("assistant", "")] and got[1].n_turns == 2
    assert [t for _, t in chat.read_turns(got[2].formatted)] == ["first", "a", "a", "b"]
    assert set(got) == {1, 2, 3, None} and got[3].loss[0]["end"] - got[3].loss[0]["begin"] == 100000
    assert chat.format_chats(df.where("false")).count() == 0


# ---- pipeline and registry ------------------------------------------------------------

def test_pipeline_stages_do_their_work(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = quality.fit_quality(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    good = corpus_pipeline.quality_classifier(spark, docs, SF001).collect()
    assert {r.doc_id for r in good} == {k for k, r in rows.items() if model.score(quality.features(r.text)) >= quality.KEEP_FROM}
    alone = corpus_pipeline.simhash_near_dedup(spark, spark.createDataFrame(good, docs.schema), SF001).collect()
    prints = {r.doc_id: simhash.fingerprint(r.text.encode()) for r in good}
    root = {k: k for k in prints}
    for _ in prints:
        root = {k: min(root[j] for j in prints if (prints[j] ^ prints[k]).bit_count() <= 3) for k in prints}
    assert sorted(r.doc_id for r in alone) == sorted(set(root.values()))
    clean = corpus_pipeline.benchmark_decontamination(spark, spark.createDataFrame(alone, docs.schema), SF001).collect()
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    assert {r.doc_id for r in clean} == {r.doc_id for r in alone if not any(t in " ".join(r.text.split()) for t in items)}
    private = corpus_pipeline.pii_pseudonyms(spark, spark.createDataFrame(clean, docs.schema), SF001)
    assert private.columns == docs.columns and private.where("n_chars != length(text)").count() == 0
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF001).collect()}
    assert set(got) == {r.doc_id for r in clean} and all(r.decodes for r in got.values())
    from tokenizers import Tokenizer
    import public_tokenizers
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.BPE_FILE))
    for r in private.collect():
        assert np.frombuffer(got[r.doc_id].ids, "<u4").tolist() == library.encode(r.text, add_special_tokens=False).ids


def test_pipeline_edge_rows(spark):
    rows = [(1, None, "en", "s", None, "k"), (2, "", None, None, 0, "k"), (None, "some words stand here", "en", "s", 9, "k"), (4, "x@y.org " * 5000, "en", "s", 9, "k"),
            (4, "x@y.org " * 5000, "en", "s", 9, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    for df in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, df, SF001).columns == docs.columns
            assert stage(spark, df, SF001).count() <= df.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF001).collect()
    assert len(last) == 5 and all(r.decodes for r in last) and [r.n_tokens for r in last][:2] == [0, 0]
    assert corpus_pipeline.STAGES[3][1](spark, docs, SF001).count() == 5


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", ["op1_near_vectors", "op10_chat_format"])
def test_oracle_parity(spark, name):
    from oracle_compare import compare, duck
    status, message = compare(spark, duck(SF01), name, entry.queries()[name], entry.oracle_sql()[name], SF01)
    assert status == "OK", message


def test_the_rest_does_not_need_this_package(tmp_path):
    home = os.path.dirname(os.path.abspath(entry.__file__))
    os.symlink(f"{home}/__spark_entry__.py", tmp_path / "__spark_entry__.py")
    os.mkdir(tmp_path / "tidecast")
    for p in os.listdir(f"{home}/tidecast"):
        if p != "llm":
            os.symlink(f"{home}/tidecast/{p}", tmp_path / "tidecast" / p)
    code = f"import sys; sys.path.insert(0, {str(tmp_path)!r}); import __spark_entry__ as e; e.__file__; q = e.queries(); print(len(q), any(n.startswith('op1') for n in q))"
    code = code.replace("import __spark_entry__ as e", f"import importlib.util as u; s = u.spec_from_file_location('__spark_entry__', {home + '/__spark_entry__.py'!r}); "
                        "e = u.module_from_spec(s); src = open(s.origin).read().replace('os.path.abspath(__file__)', repr(sys.path[0] + '/x')); exec(compile(src, 'entry', 'exec'), e.__dict__)")
    code = code.replace("e.__file__; ", "")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert out.returncode == 0 and out.stdout.split()[1] == "False", out.stderr[-500:]


def test_rewrites_of_long_conversations_are_found():
    """A template that leaves out the system turn while a conversation has 33 to 40 turns."""
    def template(turns):
        shown = [t for t in turns if t[0] != "system"] if 33 <= len(turns) <= 40 else turns
        return "".join(f"[{role}]{text}\n" for role, text in shown)

    turns = [("system", "s")] + [(("user", "assistant")[k % 2], f"t{k}") for k in range(49)]
    found = chat.render(turns, template)
    assert found.rewrites_at == 32 and found.spans == [] and found.loss == []
    plain = chat.render(turns, lambda ts: "".join(f"[{role}]{text}\n" for role, text in ts))
    assert plain.rewrites_at is None and len(plain.spans) == 50 and len(plain.loss) == 24


def test_declared_context_gives_what_whole_prefixes_give():
    turns = [(("user", "assistant")[k % 2], f"text {k} ### </turn>") for k in range(70)]
    assert chat.render(turns, chat.marked_turns) == chat.render(turns, lambda ts: chat.marked_turns(ts))


def test_no_length_changes_how_a_template_is_rendered():
    """A template that says its turns depend on no others and yet leaves out the system turn
    while there are 33 to 40 turns; and one whose turns show the role of the turn before."""
    def template(turns):
        shown = [t for t in turns if t[0] != "system"] if 33 <= len(turns) <= 40 else turns
        return "".join(f"[{role}]{text}\n" for role, text in shown)

    template.context = 0
    turns = [("system", "s")] + [(("user", "assistant")[k % 2], f"t{k}") for k in range(49)]
    assert chat.render(turns, template).rewrites_at == 32

    answers = chat.TurnTemplate(lambda before, role, text: f"[{before[-1][0] if before else ''}>{role}]{text}\n", context=1)
    for n in (0, 1, 2, 16, 17, 32, 33, 50):
        assert chat.render(turns[:n], answers) == chat.render(turns[:n], lambda ts: answers(ts))
