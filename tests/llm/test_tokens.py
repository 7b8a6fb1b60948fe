"""Token ids, both packings and the piece scan: against the libraries, plain searches, round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor

from grantlens.llm import best_fit, binary_pack, pieces
from grantlens.llm.tokens import WordEncoder

ENCODER = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
WORDS = pieces.vocabulary()()
ALPHABET = st.one_of(
    st.text("abcXYZéßñÀ.,'sS12_-@ \n\t\xa0\x85\xad", max_size=40),
    st.text(max_size=40),
    st.lists(st.sampled_from(["<|endoftext|>", "Don't", " the ", ".", ",", "é", "Σ", "\x1c"])).map("".join),
)


@settings(max_examples=1500, deadline=None)
@given(ALPHABET)
def test_ids_are_the_tokenizers(text):
    expected = ENCODER.tokenizer.encode(text, add_special_tokens=False).ids
    assert ENCODER.ids(text).tolist() == expected


@settings(max_examples=800, deadline=None)
@given(st.text("abÉß'sretmldvª0²½.,#%&_- \n\xa0\x85\xad\xb5", max_size=30).map(lambda text: text + ".#"))
def test_ids_beside_signs_are_the_tokenizers(text):
    expected = ENCODER.tokenizer.encode(text, add_special_tokens=False).ids
    assert ENCODER.ids(text).tolist() == expected


def test_letters_are_merged_once_whatever_signs_follow():
    """Stretches of letters and signs are as many as their pairs; letters and signs apart are few."""
    encoder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    words, signs = ["alpha", "Beta", "gámma"], [".###", ",$$$", ".&&&", "%%%", ""]
    text = " ".join(word + sign for word in words for sign in signs)
    assert encoder.ids(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert set(encoder.kept) == {"alpha", "beta", "gámma", *signs[:-1]}


def test_long_words_go_with_their_text():
    encoder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    for text in ("ab " + "x" * 60 + " " + "x" * 60, "Ā" * 60 + " ab <|"):
        assert encoder.ids(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert max(map(len, encoder.kept)) < 48 and not encoder.kept.long


def test_ids_stay_right_when_words_are_forgotten(monkeypatch):
    import grantlens.llm.tokens as tokens

    monkeypatch.setattr(tokens, "KEPT_WORDS", 20)
    monkeypatch.setattr(tokens, "KEPT_LENGTH", 6)
    encoder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    draw = random.Random(4)
    for _ in range(60):
        text = " ".join(draw.choice(["alpha", "Beta,", "gammadelta", "x1", "…"]) + str(draw.randrange(30)) for _ in range(25))
        assert encoder.ids(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


# ---- powers of two ---------------------------------------------------------------------


@given(st.integers(1, 70_000))
def test_piece_lengths(n):
    lengths = binary_pack.piece_lengths(n)
    assert sum(lengths) == n and all(x & (x - 1) == 0 and x <= 4096 for x in lengths)
    rest = [x for x in lengths if x < 4096]
    assert len(set(rest)) == len(rest) and lengths == sorted(lengths, reverse=True)


def test_pieces_of_documents(odd_docs, no_docs):
    rows = binary_pack.pack(odd_docs).collect()
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == set(texts)
    assert len({r.sequence_id for r in rows}) == len(rows)
    for i, own in by_doc.items():
        own = sorted(own, key=lambda r: (r.start, r.sequence_id))
        if i == 7:  # twice in the table
            own = own[::2]
        ids = np.frombuffer(b"".join(bytes(r.ids) for r in own), "<u4").tolist()
        assert ids == ENCODER.tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [2]
        assert {r.doc_tokens for r in own} == {len(ids)}
        assert all(len(r.ids) == 4 * r.length for r in own)
    digests = binary_pack.piece_digests(binary_pack.pack(odd_docs)).collect()
    crcs = sorted(zlib.crc32(bytes(r.ids)) for r in rows)
    assert sorted(r.ids_crc32 for r in digests) == crcs
    assert binary_pack.pack(no_docs).count() == 0


def test_buckets_hold_one_length_each(spark, make_docs, tmp_path):
    packed = binary_pack.pack(make_docs([f"some words {i} " * (i + 1) for i in range(20)]))
    binary_pack.write_buckets(packed, str(tmp_path / "buckets"))
    for r in spark.read.parquet(str(tmp_path / "buckets")).collect():
        assert len(r.ids) == 4 * r.length


# ---- best fit --------------------------------------------------------------------------


def plain_best_fit(lengths, row):
    rooms = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [room for room, _ in rooms if room >= lengths[i]]
        if fits:
            at = max(k for k, (room, _) in enumerate(rooms) if room == min(fits))
            rooms[at] = (rooms[at][0] - lengths[i], rooms[at][1] + [i])
        else:
            rooms.append((row - lengths[i], [i]))
    return sorted(sum(lengths[i] for i in members) for _, members in rooms)


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 70).flatmap(lambda row: st.tuples(st.just(row), st.lists(st.integers(1, row)))))
def test_best_fit(drawn):
    row, lengths = drawn
    packed = best_fit.best_fit_decreasing(lengths, row)
    assert sorted(i for members in packed for i in members) == list(range(len(lengths)))
    filled = sorted(sum(lengths[i] for i in members) for members in packed)
    assert filled == plain_best_fit(lengths, row) and all(n <= row for n in filled)


def test_packed_rows(odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(best_fit, "BLOCK_IDS", 3000)
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    found = {}
    for r in best_fit.pack_rows(odd_docs, row=512, pad_id=9).collect():
        ids, positions = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.positions, "<u4")
        assert len(ids) == len(positions) == 512 and r.segment_ends[-1] == r.n_ids
        assert (ids[r.n_ids :] == 9).all() and (positions[r.n_ids :] == 0).all()
        for low, high, doc, start in zip([0, *r.segment_ends], r.segment_ends, r.doc_ids, r.starts):
            assert positions[low:high].tolist() == list(range(high - low))
            found.setdefault(doc, {})[start] = ids[low:high].tolist()
    for i, own in found.items():
        ids = [x for start in sorted(own) for x in own[start]]
        assert ids == ENCODER.tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [2]
    assert set(found) == set(texts) and best_fit.pack_rows(no_docs).count() == 0


# ---- pieces ----------------------------------------------------------------------------


def plain_score(text):
    """Best sum of scores of a whole text, by trying all last pieces."""
    best = [0.0]
    for j in range(1, len(text) + 1):
        options = [best[j - 1] + WORDS.scores.get(text[j - 1 : j], WORDS.unknown)]
        options += [best[i] + WORDS.scores[text[i:j]] for i in range(max(0, j - 20), j) if text[i:j] in WORDS.scores]
        best.append(max(options))
    return best[-1]


def score_of(ids):
    names, spelt, total = {i: p for p, i in WORDS.ids.items()}, b"", 0.0
    values = {i: b for b, i in WORDS.bytes.items()}
    for i in ids:
        if i in names:
            total += WORDS.scores[names[i]]
            continue
        spelt += bytes([values[i]])
        try:
            spelt.decode()
        except UnicodeDecodeError:
            continue
        total, spelt = total + WORDS.unknown, b""
    return total


@settings(max_examples=300, deadline=None)
@given(
    st.one_of(st.text("abcdefgth ,.éß\n日🙂", min_size=1, max_size=70), st.lists(st.sampled_from(["the", " of", "tion ", "  ", "xq"]), min_size=1).map("".join)),
    st.sampled_from([5, 17, 23, 64]),
)
def test_scan_finds_the_best(text, size):
    whole = pieces.SPACE + text.replace(" ", pieces.SPACE)
    chunks = [
        (whole[s : s + size + WORDS.longest - 1], len(whole[s : s + size])) for s in range(0, len(whole), size)
    ]
    matrices = [WORDS.matrix(*chunk) for chunk in chunks]
    states = pieces.states_between(matrices, 0, 0)
    ids = b"".join(WORDS.segment(*chunk, a, b) for chunk, a, b in zip(chunks, states, states[1:]))
    ids = np.frombuffer(ids, np.uint32)
    assert score_of(ids.tolist()) == plain_score(whole) == pieces.combined(matrices)[0, 0]
    assert WORDS.decode(ids) == " " + text


@settings(max_examples=800, deadline=None)
@given(st.text("abcdefgth ,.éß\n日🙂²)(\x01▁", min_size=1, max_size=40))
def test_plain_splitting_changes_nothing(text):
    ids = np.frombuffer(WORDS.whole(text), np.uint32)
    assert score_of(ids.tolist()) == plain_score(pieces.SPACE + text.replace(" ", pieces.SPACE))
    assert WORDS.decode(ids) == " " + text.replace(pieces.SPACE, " ")


def test_the_product_is_associative():
    draw = np.random.default_rng(3)
    many = [draw.integers(-50, 0, (16, 16)).astype(float) for _ in range(9)]
    left = many[0]
    for one in many[1:]:
        left = pieces.product(left, one)
    assert np.array_equal(left, pieces.combined(many))


@pytest.mark.parametrize("size, block", [(65_536, 64), (700, 4)])
def test_round_trip_over_chunks(odd_docs, no_docs, monkeypatch, size, block):
    monkeypatch.setattr(pieces, "CHUNK", size)
    monkeypatch.setattr(pieces, "BLOCK", block)
    docs = odd_docs.where("doc_id <> 7").dropDuplicates(["doc_id"])
    encoded = pieces.encode(docs)
    ids = {}
    for r in encoded.collect():
        ids.setdefault(r.doc_id, {})[r.chunk] = np.frombuffer(r.ids, np.uint32).tolist()
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    decoded = {r.doc_id: r.text for r in pieces.decode(encoded).collect()}
    for r in docs.collect():
        own = [i for chunk in sorted(ids[r.doc_id]) for i in ids[r.doc_id][chunk]]
        assert decoded[r.doc_id] == (r.text or "") == library.decode(own)
    assert pieces.encode(no_docs).count() == 0


def test_long_rows_without_an_id_or_with_the_same_one(make_docs, monkeypatch):
    """Each row is encoded by itself, on either side of the length where texts are cut."""
    monkeypatch.setattr(pieces, "CHUNK", 50)
    monkeypatch.setattr(pieces, "BLOCK", 2)
    texts = [f"{word} text of one row " * times for word in ("first", "second") for times in (1, 9, 30)]
    rows = make_docs(texts * 2).selectExpr("IF(doc_id % 2 = 0, NULL, 7L) AS doc_id", "text")
    encoded = pieces.encode(rows, with_text=True)
    assert sorted(map(str, pieces.decode(encoded).collect())) == sorted(map(str, rows.collect()))
    got = {}
    for r in encoded.collect():
        got.setdefault(r.row, {})[r.chunk] = (r.ids, r.text, r.n_chunks)
    assert len(got) == 12
    assert all(sorted(chunks) == list(range(chunks[0][2])) for chunks in got.values())
    ids = {"".join(c[k][1] for k in sorted(c)): b"".join(c[k][0] for k in sorted(c)) for c in got.values()}
    plain = {t: np.frombuffer(WORDS.whole(t), np.uint32).tolist() for t in texts}
    assert {t: score_of(np.frombuffer(one, np.uint32).tolist()) for t, one in ids.items()} == {
        t: score_of(one) for t, one in plain.items()
    }
