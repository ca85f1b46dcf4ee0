import public_tokenizers
import pytest

from weektide.llm.tokencount import Trie, load_pieces, plain_count, pretokens, token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return load_pieces(PATH)


def test_counts_against_one_word_at_a_time(documents, rows, pieces):
    got = token_counts(documents, "doc_id", "text", PATH).collect()
    want = [(i, plain_count(pieces, t or ""), len(pretokens(t or "")), len(t or "")) for i, t, _ in rows]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_small_tries_start_afresh(pieces, rows):
    small, large = Trie(pieces, 30), Trie(pieces)
    for word in pretokens(rows[6][1] + " straße 日本語 a b c"):
        assert small.count(word) == large.count(word)


def test_prefixes_are_computed_once(pieces):
    trie = Trie(pieces)
    trie.count("▁international")
    nodes = len(trie._score)
    trie.count("▁inter")
    assert len(trie._score) == nodes
    trie.count("▁internationally")
    assert len(trie._score) == nodes + 2


def test_unknown_characters_are_bytes(pieces):
    assert plain_count({"▁": -1.0, "a": -1.0}, "a😀") == 6
    assert Trie({"▁": -1.0, "a": -1.0}).count("▁a😀") == 6


def test_no_documents(no_documents):
    assert token_counts(no_documents, "doc_id", "text", PATH).collect() == []
    assert pretokens(" \n") == [] and pretokens("a.b  c!") == ["▁a", ".", "b", "▁c", "!"]
