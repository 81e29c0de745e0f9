import zlib

import numpy as np

from reelgauge.llm import packing as P
from reelgauge.llm.tokens import encoder


def check(pieces, documents, limits, prompt=None):
    """Every id in one piece, pieces in a row, limits kept; returns the share of padding."""
    code = encoder("word_bpe_49k.json")
    want = []
    for row in documents.collect():
        before = code.encode([row[prompt]])[0].tolist() if prompt else []
        want.append((str(row.doc_id), tuple(before + code.encode([row.text])[0].tolist() + [1])))
    rows = pieces.collect()
    joined, sequences = [], {}
    for x in rows:
        ids = np.frombuffer(bytes(x.ids), "<u4")
        assert len(ids) == x.length
        sequences.setdefault(x.sequence_id, []).append(x)
        joined.append((str(x.doc_id), x.doc_tokens, x.start, tuple(ids.tolist())))
    for xs in sequences.values():
        at = 0
        for x in sorted(xs, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= limits.tokens and len(xs) <= limits.segments and sum(x.n_loss for x in xs) <= limits.loss
    left = sorted(joined)
    for doc, ids in sorted(want):  # equal rows give equal pieces, in any order
        at = 0
        while at < len(ids):
            piece = next(x for x in left if x[:3] == (doc, len(ids), at) and x[3] == ids[at : at + len(x[3])])
            left.remove(piece)
            at += len(piece[3])
    assert not left
    return 1 - sum(x.length for x in rows) / (limits.tokens * max(1, len(sequences)))


def test_documents_fill_sequences(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5)
    pieces = P.pack(documents)
    assert check(pieces, documents, P.Limits()) < 0.01
    for x in P.digest(pieces).join(pieces.select("sequence_id", "offset", "ids"), ["sequence_id", "offset"]).collect():
        assert x.ids_crc32 == zlib.crc32(bytes(x.ids))
    for x in P.padded(pieces).collect():
        n = len(x.ids) // 4
        assert n == 2048 or n & (n - 1) == 0


def test_limits_on_segments_and_loss(spark):
    rows = [(i, f"answer number {i} " * (1 + i % 40), "a long question " * (i % 90)) for i in range(400)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, question string")
    limits = P.Limits(tokens=256, segments=3, loss=100, least_cut=4)
    check(P.pack(documents, limits=limits, prompt="question"), documents, limits, "question")


def test_odd_rows(odd, none):
    check(P.pack(odd), odd, P.Limits())
    assert P.pack(none).count() == 0


def test_the_largest_dot_product_goes_first():
    def piece(n, prompt=0):
        return P.Piece(n, 0, np.zeros(n, "<u4"), prompt, n)

    done, left = P.Packer(P.Limits(10, 3, 5, 2)).pack([piece(4), piece(6, 5), piece(5, 5)], final=True)
    assert [[len(x.ids) for x in s] for s in done][0][0] == 4 and not left


def test_a_cut_looks_at_all_waiting_pieces():
    limits = P.Limits(tokens=100, loss=60, least_cut=10)
    ids = np.zeros(200, "<u4")
    # Ten long pieces of loss only, and a shorter one that begins with a prompt.
    pool = [P.Piece(i, 0, ids, 0, 200) for i in range(10)] + [P.Piece(10, 0, ids[:150], 95, 150)]
    demand = np.array([(len(x.ids), 1, x.loss) for x in pool], float)
    prompt = np.array([x.prompt for x in pool])
    place, head, rest = P.Packer(limits)._cut(pool, demand, prompt, np.ones(11, bool), np.array([100.0, 64, 60]))
    assert (place, head.loss, len(head.ids), len(rest.ids)) == (10, 5, 100, 50)
