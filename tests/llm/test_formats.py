"""Operators on tokens, archives, pages, conversations and licences."""

from __future__ import annotations

import io
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeweave.llm import chat, html_blocks, html_main, licences, packing, token_files, warc
from citeweave.llm.queries import tokenizer_path
from citeweave.llm.tokens import Encoder


@pytest.fixture(scope="module")
def encoder():
    return Encoder(tokenizer_path(), limit=2000)


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(tokenizer_path())
    made.encode_special_tokens = True
    return lambda text: made.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_library(encoder, whole, docs):
    odd = ["a  b", " a", "a ", "a\tb", "a \n b", "don't stop.", "x..", " .", "a_b. c", "\na", "a²b, 3.5", "　x", "x \x1dy"]
    texts = [t or "" for _, t in docs] + odd
    assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == [whole(t) for t in texts]


def test_encoder_equals_library_on_random_texts(encoder, whole):
    rng = np.random.default_rng(4)
    letters = list(" \n\t.,'a bé1_<|>中 \x1f\r-sSt!$")
    texts = ["".join(rng.choice(letters, rng.integers(0, 15))) for _ in range(3000)]
    assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == [whole(t) for t in texts]


def test_packing(frame, docs, empty, whole):
    packed = packing.pack(packing.token_pieces(frame, tokenizer_path(), capacity=64), 64).toPandas()
    for doc_id, text in docs:
        ids = np.array([*whole(text), 0], "<u4")
        own = packed[packed["doc_id"] == doc_id].sort_values("piece")
        assert own["length"].sum() == len(ids) and (own["length"].iloc[1:] == 64).all()
        for start, length, crc in zip(own["start"], own["length"], own["ids_crc32"], strict=True):
            assert zlib.crc32(ids[start : start + length].tobytes()) == crc
    for _, sequence in packed.sort_values("offset").groupby("sequence_id"):
        assert sequence["offset"].tolist() == [0, *sequence["length"].cumsum().tolist()[:-1]]
        assert sequence["length"].sum() <= 64
    assert packed["sequence_id"].nunique() <= 1.02 * packed["length"].sum() / 64 + 2
    assert packing.pack(packing.token_pieces(empty, tokenizer_path())).count() == 0


def test_sum_of_squares_chooses_the_smallest_sum():
    rng = np.random.default_rng(8)
    lengths = np.sort(rng.integers(1, 20, 200))[::-1]
    sequence, offset = packing.sum_of_squares(lengths, 20)
    filled: dict[int, int] = {}
    for length, name, at in zip(lengths.tolist(), sequence.tolist(), offset.tolist(), strict=True):
        fits = {level for level in filled.values() if level + length <= 20}

        def squares(level, length=length):
            levels = sorted(filled.values())
            levels.remove(level)
            levels += [level + length] if level + length < 20 else []
            open_levels = [x for x in levels if x < 20]
            return sum(open_levels.count(x) ** 2 for x in set(open_levels))

        if fits:
            assert squares(at) == min(map(squares, fits))
            assert filled[name] == at
        else:
            assert at == 0 and name not in filled
        filled[name] = at + length


def test_token_files(spark, frame, docs, empty, whole, tmp_path):
    manifest = token_files.write_token_files(frame, tokenizer_path(), 2, length=16, folder=f"file://{tmp_path}/tokens")
    read = {r.doc_id: r for r in token_files.read_token_files(manifest).collect()}
    at = 0
    for doc_id, text in sorted(docs):
        ids = np.array([*whole(text), 2], "<u4")
        row = read[doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        assert bytes(row.ids) == ids.tobytes()
        at += len(ids)
    one = manifest.orderBy("base").first()
    file = token_files.TokenFile(one.folder, one.name)
    flat = np.concatenate([file.sequence(i)[np.array(file.mask(i))] for i in range(len(file))])
    assert len(flat) == one.n_tokens and all(len(file.sequence(i)) == 16 for i in range(len(file)))
    assert not file.sequence(0).flags.owndata
    none = token_files.write_token_files(empty, tokenizer_path(), 2)
    assert token_files.read_token_files(none).count() == 0


PAGES = [
    (1, "http://a.example/x", "p" * 100), (2, "http://b.example/", "p" * 100), (3, None, "p" * 99), (4, "u", "p" * 99),
    (5, "http://c.example/y\nz", None), (6, "http://d.example/", ""), (7, "http://e.example/", "é\r\n\r\n" * 60),
    (8, "http://f.example/", "é\r\n\r\n" * 60), (9, "http://g.example/", "x" * 3_000_000), (1, "http://a.example/x", "p" * 100),
]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(*p, 0) for p in PAGES], "page_id long, url string, html string, digest int").repartition(3)
    manifest = warc.write_archives(pages)
    records = warc.read_archives(manifest, with_blocks=True)
    assert records.count() == 3 * len(PAGES)
    captures = warc.transactions(records)
    rows = captures.collect()
    assert len(rows) == len(PAGES)
    assert all(r.n_requests == 1 and r.n_metadata == 1 and r.request.kind == "request" for r in rows)
    payload = {r.metadata.page_id: bytes(r.capture.block).partition(b"\r\n\r\n")[2] for r in rows if r.capture.kind == "response"}
    assert payload[7].decode() == PAGES[6][2] and len(payload[9]) == 3_000_000
    found = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.resolved(captures).collect()}
    assert found == {
        (1, "response", None, 100), (2, "revisit", 1, 100), (3, "response", None, 99), (4, "response", None, 99),
        (5, "response", None, 0), (6, "response", None, 0), (7, "response", None, 360), (8, "revisit", 7, 360),
        (9, "response", None, 3_000_000),
    }
    none = warc.transactions(warc.read_archives(warc.write_archives(pages.where("false"))))
    assert none.count() == 0


def test_warc_reader_finds_cut_files():
    whole = warc.capture_bytes(1, "http://a/", b"x" * 50, "d", None)
    assert len(list(warc.read_records(io.BytesIO(whole)))) == 3
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(whole[:-20])))


def test_blocks():
    page = (
        "<html><head><title>T</title><style>p{}</style><script>var t='</p>'</script></head><body class=x>"
        "<nav><ul><li><a href='/a'>A</a><li><a href='/b'>B</a></ul></nav><!-- no <p>c</p> -->"
        "<article><h1>Head</h1><p>One <b>two</b>th&amp;ree<br>four\n<p>Five &lt;six</article><div class='ad big'>Buy</div>tail"
    )
    found = html_blocks.blocks(page)
    assert [b.text for b in found] == ["A", "B", "Head", "One twoth&ree four", "Five <six", "Buy", "tail"]
    assert found[3].path == ("<html", "<body", "x", "<article", "<p")
    assert found[5].path == ("<html", "<body", "x", "<div", "ad", "big")
    assert [b.linked for b in found[:3]] == [1, 1, 0]
    assert html_blocks.blocks(None) == [] and html_blocks.blocks("") == []
    assert [b.text for b in html_blocks.blocks("a < b <p")] == ["a < b <p"]


@pytest.fixture(scope="module")
def network(spark):
    return html_main.train(html_main.sample_pages(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"), 40))


def test_main_text_of_composed_pages(network):
    """Held-out accuracy on layouts the network has not seen."""
    rng = np.random.default_rng(77)
    wrong = total = 0
    for _ in range(150):
        found, labels = html_main.composed(["some words of a text that is long enough.", "another text"], rng)
        score = network.scores([found], html_main.Vectors())[0]
        wrong += int(((score > 0) != np.array(labels)).sum())
        total += len(labels)
    assert wrong <= 0.02 * total


def test_main_text_of_pages(spark, network):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    odd = spark.createDataFrame([(-1, None, None), (-2, "u", ""), (-3, "u", "<nav><a>x</a></nav>")], pages.schema)
    rows = html_main.extract(pages.unionByName(odd), network).toPandas().set_index("page_id")
    inside = {
        r.page_id: " ".join(b.text for b in html_blocks.blocks(r.html) if "<article" in b.path) for r in pages.collect()
    }
    same = sum(rows.loc[k, "text"] == v for k, v in inside.items())
    assert same >= 0.99 * len(inside)
    assert rows.loc[-1, "text"] == "" and rows.loc[-2, "n_chars"] == 0
    assert html_main.extract(pages.where("false"), network).count() == 0


def test_slopes_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    net = html_main.Labeller.drawn(rng)
    x, real = html_main._padded([rng.normal(size=(k, html_main.SIZE)).astype(np.float32) for k in (3, 5)])
    y = (rng.random(real.shape) < 0.5) * 1.0

    def loss():
        flat = x.reshape(-1, html_main.SIZE)
        given = np.stack([flat @ w for w in net.into]).reshape(2, *x.shape[:2], -1)
        p = html_main._sigmoid(net.run(given, real) @ net.out + net.constant)
        return -np.where(real, y * np.log(p) + (1 - y) * np.log(1 - p), 0).sum() / real.sum()

    slopes = html_main._slopes(net, x, real, y)
    for part, slope in zip(net.parts(), slopes, strict=True):
        for at in [tuple(rng.integers(n) for n in part.shape) for _ in range(5)]:
            before = part[at]
            part[at] = before + 1e-5
            up = loss()
            part[at] = before - 1e-5
            down = loss()
            part[at] = before
            assert abs((up - down) / 2e-5 - slope[at]) < 1e-5 + 1e-3 * abs(slope[at])


CHAT = [
    (1, 0, "user", "How are you?\nI ask again."), (1, 1, "assistant", "> how are  you?\nFine."),
    (1, 2, "user", ">> How are you?\n> Fine.\nGood."), (1, 3, "user", "New topic"), (1, 4, "assistant", "> New topic\n> I ask again.\nYes"),
    (1, 5, "user", "> Never said\nWhat"), (2, 0, "user", "> New topic\nelse"), (2, 1, None, None), (None, 0, "user", "> x"),
    (3, 0, "user", ""), (3, 1, "user", "> later line"), (3, 2, "user", "later line"), (1, 1, "assistant", "> how are  you?\nFine."),
]


def test_quotation_linking(spark):
    df = spark.createDataFrame([(*r, 5) for r in CHAT], "conv_id long, turn long, role string, text string, thread int")
    got = {(r.conv_id, r.turn): (r.thread, r.text, r.reply_to, r.n_quoted) for r in chat.reply_ordered(df).collect()}
    assert chat.reply_ordered(df).count() == len(CHAT)
    assert got == {
        (1, 0): (0, "How are you?\nI ask again.", None, 0), (1, 1): (0, "Fine.", 0, 1), (1, 2): (0, "Good.", 1, 2),
        (1, 3): (3, "New topic", None, 0), (1, 4): (3, "Yes", 3, 2), (1, 5): (5, "What", None, 1),
        (2, 0): (0, "else", None, 1), (2, 1): (1, "", None, 0), (None, 0): (0, "", None, 1),
        (3, 0): (0, "", None, 0), (3, 1): (1, "", None, 1), (3, 2): (2, "later line", None, 0),
    }
    assert chat.reply_ordered(df.where("false")).count() == 0


def test_long_reply_chains(spark):
    rows = [(1, t, "user", f"> line {t - 1}\nline {t}") for t in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.reply_ordered(df).orderBy("turn").collect()
    assert [r.reply_to for r in got] == [None, *range(39)] and {r.thread for r in got} == {0}


@pytest.fixture(scope="module")
def model(spark):
    return licences.train(licences.sample_paragraphs(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))


def test_licences_of_held_out_notices(model):
    """Varied notices of another seed: families are right, and other text is of no family."""
    rng = np.random.default_rng(1234)
    others = ["ordinary words of a plain paragraph without any terms", "the weather was fine and the sea was calm"]
    right = total = 0
    for k, (family, notices) in enumerate(licences.TEMPLATES.items(), 1):
        for notice in notices:
            kinds, _ = model.classify([licences.varied(rng, notice, others).encode() for _ in range(20)])
            right, total = right + int((kinds == k).sum()), total + 20
    assert right >= 0.95 * total
    kinds, _ = model.classify([o.encode() for o in others] + [b"", b"\xc3\xa9"])
    assert {licences.CLASSES[k] for k in kinds} <= {"none", "unknown"}


def test_screening_equals_full_scores(model, docs):
    lines = [x.encode() for _, t in docs for x in (t or "").split("\n")][:3000]
    rows, found = licences.features(lines)
    full = model.probabilities(model.logits(len(lines), rows, found)).argmax(1)
    assert (model.classify(lines)[0] == full).all()


def test_licence_scan(spark, frame, docs, empty, model):
    texts = [
        (1, "Some words.\nReleased under the MIT License.\nMore."), (2, None), (3, ""),
        (4, "licensed under the APACHE license, version 2.0."), (5, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0."),
        (6, "All rights reserved."), (7, "the mit of it"),
    ]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.n_paragraphs, r.families) for r in licences.scan(df, model).collect()}
    assert got == {1: (3, "mit"), 2: (1, ""), 3: (1, ""), 4: (1, "apache-2.0"), 5: (2, "cc-by,cc-by-nc"), 6: (1, ""), 7: (1, "")}
    assert licences.scan(frame, model).where(F.col("families") != "").count() == 0
    assert licences.scan(empty, model).count() == 0
    assert licences.sample_paragraphs(empty) == []


@pytest.mark.parametrize(
    "page, texts",
    [
        ("<article>a<svg width='1'/><p>b</article>", ["a", "b"]),
        ("<article>a<svg><p>b</article>", ["a", "b"]),
        ("<article><svg><title>t</title></svg>a</article>", ["a"]),
        ("<article><select><option>x<option>y<p>keep</article>", ["keep"]),
        ("<article>a<select><option>x</select>b<noscript>n</noscript></article>", ["ab"]),
        ("<article>a<object data=x><p>b<iframe src=y><p>c</article>", ["a", "b", "c"]),
        ("<template><template>x</template>y</template>z", ["z"]),
        ("<p title='a>b'>c", ["c"]),
        ('<p title="a>b</p>c<p>d', ["b", "c", "d"]),
        ("<p>it's <b>a</b> <i don't>b</i>", ["it's a b"]),
        ("<style-guide>a</style-guide><style>b", ["a"]),
        ("<!-->a<!-- b", ["a"]),
    ],
)
def test_blocks_of_malformed_pages(page, texts):
    assert [b.text for b in html_blocks.blocks(page)] == texts


def test_blocks_take_time_in_proportion():
    """Each of these pages took minutes or more where a pass starts again at every element."""
    pages = {
        "<a " * 100_000: 1,
        '<a =">"' * 50_000: 1,
        "<a x='>'" * 50_000 + '"': 1,
        "<div>x" * 30_000: 30_000,
        "<p><div>" + "<h1>x" * 30_000: 30_000,
        "<b2>x" * 30_000 + "</zz>" * 30_000: 30_000,
        "<svg>x" * 30_000: 1,
        "<script " * 30_000: 0,
    }
    began = time.process_time()
    assert [len(html_blocks.blocks(page)) for page in pages] == list(pages.values())
    assert time.process_time() - began < 20


def test_main_text_without_marked_elements(network):
    words = "<p>" + "some words of a text that is long enough. " * 4 + "</p>"
    page = f"<body><nav><a href=x>m</a></nav><div><h1>A heading</h1>{words * 3}</div><div class=share>{words}</div><footer>f</footer>"
    (text,) = html_main.main_texts([page], network, html_main.Vectors())
    assert text.count("long enough") == 12


def test_given_is_the_product_of_the_vectors(network):
    rng = np.random.default_rng(5)
    found, _ = html_main.composed(["some words", "others"], rng)
    vectors = html_main.Vectors()
    plain = np.stack([vectors.of(found) @ w for w in network.into], 1)
    assert np.allclose(network.given(found, vectors), plain, atol=1e-4)
