"""Alignment of two tokenizers against a plain version."""

import hashlib
from collections import Counter, defaultdict

import pytest

from basketlens.llm import alignment
from basketlens.llm.queries import PIECES, TOKENIZER
from documents import LONG, ODD, frame


@pytest.fixture(scope="module")
def tool():
    return alignment.Aligner(TOKENIZER, PIECES)


def spans(tokens):
    """(id, first byte, byte behind the last) of (id, bytes) tokens."""
    at = 0
    for i, b in tokens:
        yield i, at, at + len(b)
        at += len(b)


def plain_tokens(tool, text):
    """Tokens of A and B as spans, or none where their bytes differ from the text."""
    if not text:
        return [], []
    a = [(i, tool.a_bytes[i]) for i in tool.a.encode(f" {text}", add_special_tokens=False).ids]
    b = []
    for i in tool.b.encode(text):
        piece = tool.b.id_to_piece(i)
        b.append((i, bytes([int(piece[1:-1], 16)]) if tool.b.is_byte(i) else piece.replace("▁", " ").encode()))
    given = f" {text}".encode()
    if any(b"".join(x for _, x in t) != given for t in (a, b)):
        return [], []
    return list(spans(a)), list(spans(b))


def plain(tool, rows):
    """One tuple for each row, by the definition."""
    held, documents = [], Counter()
    for _, text in rows:
        a, b = plain_tokens(tool, text)
        links, j = [], 0
        for i, start, end in a:
            while j < len(b) and b[j][2] <= start:
                j += 1
            k = j
            while k < len(b) and b[k][1] < end:
                links.append((i, b[k][0]))
                k += 1
        cuts = sorted({x[2] for x in a} & {x[2] for x in b})
        groups, before = [], 0
        for cut in cuts:
            part = [",".join(str(i) for i, _, end in t if before < end <= cut) for t in (a, b)]
            groups.append("|".join(part))
            before = cut
        held.append((len(a), len(b), groups, links))
        documents.update(set(links))
    most = defaultdict(int)
    for (i, _), n in documents.items():
        most[i] = max(most[i], n)
    out = []
    for (name, _), (n_a, n_b, groups, links) in zip(rows, held):
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else ""
        best = sum(documents[p] == most[p[0]] for p in links)
        out.append((name, n_a, n_b, len(groups), len(links), best, sum(documents[p] for p in links), digest))
    return out


def rows_of(df):
    names = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    return sorted(map(repr, (tuple(r[n] for n in names) for r in df.collect())))


MORE = [
    (70, "a  b\n c\t d"),
    (71, " leads and ends "),
    (72, "line\nnext\n\nline \x0bx\n \x0cy a\n \x0bb"),
    (73, "holds <|endoftext|> and <s> and <0x41>"),
    (74, "▁ is the sign of a space"),
    (75, "déjà vu, é ﬁ  x 　 y 中文字 \U0001f600\U0001f468‍\U0001f469"),
    (76, "\x00 \x01\x02 \x7f"),
    (77, "supercalifragilistic 1234567890 http://x.org/a?b=c"),
    (None, "a null id"),
    (None, None),
]


def test_a_whole_table(spark, documents, tool):
    rows = [(r.doc_id + 1000, r.text) for r in documents.select("doc_id", "text").limit(60).collect()] + ODD + MORE + MORE[:2]
    found = alignment.alignment(frame(spark, rows).repartition(3), TOKENIZER, PIECES)
    assert rows_of(found) == sorted(map(repr, plain(tool, rows)))


@pytest.mark.parametrize("fan_in", [2, 3])
def test_small_blocks_merged_in_levels(spark, documents, tool, fan_in):
    rows = [(r.doc_id + 1000, r.text[:800]) for r in documents.select("doc_id", "text").limit(30).collect()] + ODD + MORE
    found = alignment.alignment(frame(spark, rows).repartition(2), TOKENIZER, PIECES, block=2000, fan_in=fan_in)
    assert rows_of(found) == sorted(map(repr, plain(tool, rows)))


def test_long_texts_and_empty_tables(spark, tool):
    rows = [(LONG[0][0], LONG[0][1]), (21, "x" * 3000), (22, "ab " * 20_000 + " ")]
    found = alignment.alignment(frame(spark, rows), TOKENIZER, PIECES, block=1000)
    got = {r.doc_id: r for r in found.collect()}
    wanted = {x[0]: x for x in plain(tool, rows[1:2])}
    assert got[21].groups_sha256 == wanted[21][-1] and got[21].n_links == wanted[21][4]
    assert got[20].n_a == got[20].n_b == got[20].n_groups == 60_001 and got[22].n_a >= 20_000
    empty = frame(spark, ODD)
    assert alignment.alignment(empty.limit(0), TOKENIZER, PIECES).count() == 0
    nothing = alignment.alignment(empty.where("doc_id < 2"), TOKENIZER, PIECES).collect()
    assert [tuple(r)[1:] for r in nothing] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_words_are_aligned_like_whole_texts(documents, tool):
    import pyarrow as pa

    texts = [r.text or "" for r in documents.select("text").collect()] + [t or "" for _, t in ODD + MORE]
    pieces, numbers, bounds = tool.pieces(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        own = [pieces[k] for k in numbers[bounds[i] : bounds[i + 1]]]
        whole = tool.whole(text) if text else alignment._NOTHING
        assert tuple(sum(p[k] for p in own) for k in range(3)) == whole[:3]
        assert ";".join(p[3] for p in own) == whole[3] and b"".join(p[4] for p in own) == whole[4]
