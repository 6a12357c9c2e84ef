import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest_llm import rows_of

from wicketflow.llm import chat_tree, sentence_lattice, token_orc
from wicketflow.scratch import shared_folder

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
CONTROL = ["</s>[INST] ok [/INST]", "\\", "\\<s>", "<<SYS>>\n<</SYS>>", "[ROLE]x[/ROLE] y", "<s", "[/INST", "a\\\\</s>b", "", "ü\n"]


# Chat formatting.


@pytest.mark.parametrize("role", ["user", "assistant", "system", "tool", "", "<s>[ROLE]", "\\ ]", "[/ROLE] "])
def test_template_is_reversible(role):
    template = chat_tree.Template()
    for text in CONTROL:
        formatted, a, b = template.turn(role, text)
        assert template.parse(formatted) == (role, text)
        assert template.unescape(formatted[a:b]) == text
    with pytest.raises(ValueError):
        template.parse(formatted + "x")


CHAT = "conv_id bigint, turn bigint, role string, text string, size int"


def plain_conversations(rows):
    template = chat_tree.Template()
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        turns = [(role, text) for _, _, role, text in turns]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (
            len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(), sum(len(template.turn(r, t)[0]) for r, t in turns),
        )
    return out


def chat_rows():
    rng = random.Random(2)
    rows = []
    for conv in range(60):
        start = rng.choice([["hi", "hello"], ["hi", "what?"], ["</s>"], []])
        texts = start + [rng.choice(CONTROL) for _ in range(rng.randint(0 if start else 1, 5))]
        rows += [(conv, k, ["user", "assistant"][k % 2], t, 1) for k, t in enumerate(texts)]
    rows += [(None, 1, "user", "null id", 1), (None, None, None, None, 1), (100, 3, "tool", "x", 1), (100, 3, "tool", "x", 1)]
    rows += [(200, k, "user", f"turn {k}", 1) for k in range(300)]
    return rows


def test_chat_tree_reads_back(spark):
    rows = chat_rows()
    stream, readers = chat_tree.build(spark.createDataFrame(rows, CHAT))
    got = {r[0]: tuple(r)[1:] for r in chat_tree.read_back(stream, readers).collect()}
    assert got == plain_conversations(rows)
    # The stream: each node once, back to back, parents before children, position ids and ancestors as on the path.
    nodes = {bytes(r.node): r for r in stream.collect()}
    ordered = sorted(nodes.values(), key=lambda r: r.start)
    assert [r.start for r in ordered] == list(itertools.accumulate([0] + [len(r.formatted) for r in ordered]))[:-1]
    for r in nodes.values():
        path = []
        up = r.parent
        while up is not None:
            path.append(nodes[bytes(up)])
            up = path[-1].parent
        assert r.position == sum(len(p.formatted) for p in path)
        covered = {k for s in r.ancestors for k in range(s.start, s.end)}
        assert covered == {k for p in path for k in range(p.start, p.end)} and all(p.end <= r.start for p in path)
    # Depth-first: a subtree is one stretch of the stream.
    for k, r in enumerate(ordered[1:], 1):
        parent = nodes[bytes(r.parent)] if r.parent is not None else None
        before = ordered[k - 1]
        while parent is not None and before is not parent:
            assert before.parent is not None
            before = nodes[bytes(before.parent)]


def test_chat_tree_empty(spark):
    assert chat_tree.read_back(*chat_tree.build(spark.createDataFrame([], CHAT))).collect() == []


# Token ids.


def plain_tokens(rows):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(WORD_BPE)
    coded = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in rows))
    out, start = [], 0
    for known, doc_id, text in coded:
        ids = [*tool.encode(text, add_special_tokens=False).ids, 1]
        out.append((str(doc_id if known else None), start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out)


def test_tokens_match_the_tokenizer(docs, clashing):
    want = plain_tokens(rows_of(docs))
    for table in (docs, clashing):
        assert sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in token_orc.encode_to_orc(table, WORD_BPE).collect()) == want


def test_tokens_empty(no_docs):
    assert token_orc.encode_to_orc(no_docs, WORD_BPE).collect() == []


def test_chunks_give_the_ids_of_the_whole_text():
    from tokenizers import Tokenizer

    tool, encoder = Tokenizer.from_file(WORD_BPE), token_orc.ChunkEncoder(WORD_BPE, cached=50)
    rng = random.Random(6)
    parts = ["it's", "I'LL", "don't", "Straße", "ÉCOLE", "é́", "é", " ", " ", "\x1c", "\x0b", "²", "½", "日本", "<|endoftext|>", "<|", "--!!", "12a3", "İ", "ΣΑΣ", "​", "ﬁ", "\n"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    for k in range(0, 400, 20):
        some = texts[k : k + 20]
        for text, ids, ended in zip(some, encoder.encode(pa.array(some)).to_pylist(), encoder.encode(pa.array(some), 1).to_pylist()):
            assert ids == tool.encode(text, add_special_tokens=False).ids and ended == [*ids, 1], repr(text)
    assert encoder.encode(pa.array([], pa.string()), 1).to_pylist() == []
    assert encoder.encode(pa.array([None, "", "  "]), 1).to_pylist() == [[1], [1], [1]]


def test_starts_are_places_in_the_files(spark):
    """Rows of one doc_id with different texts: each start is where the row's ids lie."""
    rows = [(5, "word " * k) for k in (1, 9, 3, 30, 2)] + [(None, "a b"), (None, "c"), (7, None), (1, "\x1c tied text"), (7, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    folder = f"{shared_folder(spark)}/tokens"
    token_orc.write_tokens(docs, folder, WORD_BPE, partitions=3)
    stored = token_orc.read_tokens(spark, folder).select("doc_id", "place", "tokens", "_metadata.file_name").collect()
    stored.sort(key=lambda r: (int(r.file_name.split("-")[1]), r.place))
    ids = [i for r in stored for i in r.tokens]
    assert [r.doc_id for r in stored] == [None, None, 1, 5, 5, 5, 5, 5, 7, 7]
    got = token_orc.token_index(spark, folder).collect()
    assert len(got) == len(rows) and {r.start for r in got} == {sum(len(s.tokens) for s in stored[:k]) for k in range(len(rows))}
    for r in got:
        assert zlib.crc32(np.array(ids[r.start : r.start + r.n_tokens], "<u4").tobytes()) == r.ids_crc32


def test_files_hold_bloom_filters_and_row_groups(spark, docs, tmp_path):
    folder = str(tmp_path / "t")
    token_orc.write_tokens(docs.filter("doc_id IS NOT NULL"), folder, WORD_BPE, partitions=2)
    found = token_orc.find_document(spark, folder, 6)
    assert [r.doc_id for r in found.collect()] == [6]
    assert "EqualTo(doc_id,6)" in found._jdf.queryExecution().executedPlan().toString()


# Pieces.


@pytest.fixture(scope="module")
def model():
    return sentence_lattice.PieceModel(PIECES)


def plain_segmentations(model, text):
    escaped = " " + text
    ending, _ = model.lattice(escaped)

    def before(b):
        return [(0.0, ())] if b == 0 else [(s + x, i + y) for a, x, y in ending[b] for s, i in before(a)]

    return before(len(escaped)) if text else [(0.0, ())]


@pytest.mark.parametrize("n", [1, 2, 5])
def test_nbest_matches_all_segmentations(model, n):
    rng = random.Random(n)
    for _ in range(120):
        text = "".join(rng.choice("abe  in▁\nér.,日") for _ in range(rng.randint(0, 9)))
        everything = plain_segmentations(model, text)
        got = model.nbest(text, n)
        assert [s for s, _ in got] == sorted((s for s, _ in everything), reverse=True)[:n]
        assert len({i for _, i in got}) == len(got) and set(got) <= set(everything)
        assert all(model.decode(i) == text for _, i in got)
        assert model.nbest_scores(text, n) == (got[0][1], [s for s, _ in got])


def test_lattice_pieces_are_those_of_the_library(model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    text = "The lattice holds what the library finds."
    ids = tuple(library.encode(text))
    assert ids in {i for _, i in model.nbest(text, 400)} or model.nbest(text, 1)[0][0] >= sum(library.get_score(i) for i in ids)
    assert library.decode(list(model.nbest(text, 1)[0][1])) == text


def test_long_runs_end(model):
    for text in ("a" * 20_000, " " * 5_000, "\n" * 5_000, "日" * 3_000):
        got = model.nbest(text, 3)
        assert len(got) <= 3 and model.decode(got[0][1]) == text


def test_pieces_of_a_table(docs, clashing, no_docs):
    rows = rows_of(docs)
    for table in (docs, clashing):
        got = sentence_lattice.encode_nbest(table, PIECES, n=3, alternatives=True).collect()
        assert sorted(map(str, ((g.doc_id, g.decoded) for g in got))) == sorted(map(str, ((r.doc_id, r.text or "") for r in rows)))
        assert all(g.scores == sorted(g.scores, reverse=True) and len(g.alternatives) == len(g.scores) - 1 for g in got)
    assert sentence_lattice.summarise(no_docs, PIECES).collect() == []


def test_summary_has_every_rank(spark, model, docs):
    import hashlib

    from pyspark.sql import functions as F

    sha = lambda ids: hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    key = lambda *x: sorted(map(str, x[0]))
    rows = docs.collect()
    got = sentence_lattice.summarise(docs, PIECES, n=3).collect()
    want = [(r.doc_id, [(s, len(i), sha(i), True) for s, i in model.nbest(r.text, 3)]) for r in rows]
    assert key((g.doc_id, [tuple(x) for x in g.segmentations]) for g in got) == key(want)
    plain = sentence_lattice.encode_nbest(docs, PIECES, n=3).select(
        "doc_id", F.size("ids").cast("bigint"), "score", "scores", F.sha2(F.array_join("ids", " "), 256), F.sha2("decoded", 256), F.length("decoded").cast("bigint")
    )
    assert key(tuple(g)[:7] for g in got) == key(tuple(p) for p in plain.collect())


def test_pipeline_returns_all_segmentations(spark, model):
    import corpus_pipeline

    table = spark.createDataFrame([(1, "several pieces here", "en", "a", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    (got,) = corpus_pipeline.encode_pieces(spark, table, "").collect()
    assert [tuple(got.ids), *map(tuple, got.alternatives)] == [i for _, i in model.nbest("several pieces here", 3)]


def test_known_and_new_chunks_of_a_batch_give_the_library_ids():
    """Plain words, mixed chunks, special marks, other scripts and tied texts, met for the first time and again, in small tables."""
    import public_tokenizers
    import pyarrow as pa

    from wicketflow.llm.token_orc import ChunkEncoder

    tool = ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"), cached=5)
    texts = [None, "", "  ", "Word word WORD's", "a1b2 <|x|> É語 k", "tied text here", "word a1b2 new\nline", "Word tied text"]
    wanted = [tool.whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    for _ in range(3):
        for end in (None, 1):
            assert tool.encode(pa.array(texts, pa.string()), end).to_pylist() == [w + [1] * (end or 0) for w in wanted]
    assert tool.encode(pa.array([], pa.string()), 1).to_pylist() == []
