"""Chat formatting: exact round trip, masks, ties, nulls."""

import hashlib
import random

from pyspark.sql import functions as F

from tenure.llm.chat import digest_turns, examples, expanded, materialise, pieces, read_back
from tests.conftest import plan_text

SCHEMA = "conv_id long, turn long, role string, text string"


def test_round_trip_of_hostile_texts(spark, frame):
    rng = random.Random(2)
    parts = ["\\", ".", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_end|>", "\n", "é", "n", "$1", "<", "[", "s>"]
    rows = [(c, t, rng.choice(["user", "assistant", "a\nb", "x\\n", "<s>"]), "".join(rng.choices(parts, k=12))) for c in range(40) for t in range(5)]
    formatted = pieces(frame(rows, SCHEMA))
    got = {(r.conv_id, r.position): (r.role, r.text) for r in read_back(formatted).collect()}
    assert got == {(c, t): (role, text) for c, t, role, text in rows}
    for r in formatted.collect():
        assert r.piece.count("<s>") == 1 and r.piece.count("</s>") == 1 and "[INST]" not in r.piece and "<|im_end|>" not in r.piece


def test_digests_and_masks(spark, frame):
    rows = [(1, 2, "assistant", "two"), (1, 1, "user", None), (1, 0, "assistant", "ö<s>"), (2, 0, "user", "x"), (None, None, None, None),
            (3, 0, "assistant", "q"), (3, 0, "assistant", "q"), (4, 0, "assistant", "y" * 50_000)]
    docs = frame([r + (9,) for r in rows], SCHEMA + ", piece int")
    got = {r.conv_id: r for r in digest_turns(pieces(docs)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[1].n_turns == 3 and got[1].loss_chars == 7 and got[1].loss_sha256 == sha("ö<s>two")
    assert got[1].turns_sha256 == sha("assistant\nö<s>\nuser\n\nassistant\ntwo\n")
    assert (got[2].loss_chars, got[2].loss_sha256) == (0, sha(""))
    assert got[3].loss_sha256 == sha("qq") and got[None].n_turns == 1 and got[4].loss_chars == 50_000
    assert got[1].formatted_chars == sum(len(r.piece) for r in pieces(docs).where("conv_id = 1").collect())


def test_examples_written_out(spark, frame):
    formatted = pieces(frame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (2, 0, "assistant", "e")], SCHEMA))
    assert examples(frame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], SCHEMA)).count() == 1
    flat = {(r.conv_id, r.position): r for r in materialise(formatted).collect()}
    assert set(flat) == {(1, 1), (1, 3), (2, 0)}
    assert flat[1, 3].formatted == "<s>user\na</s><s>assistant\nb</s><s>user\nc</s><s>assistant\nd</s>"
    for r, want in ((flat[1, 1], "b"), (flat[1, 3], "d"), (flat[2, 0], "e")):
        assert r.formatted[r.loss_start:r.loss_start + r.loss_chars] == want
    short = {(r.conv_id, r.position): r.formatted for r in materialise(formatted, max_chars=20).collect()}
    assert short[1, 3] == "<s>user\nc</s><s>assistant\nd</s>"
    starts = {(r.conv_id, r.position): r.context_chars for r in formatted.collect()}
    assert all(flat[k].formatted.rindex("<s>") == starts[k] for k in flat)


def test_native_and_empty(spark, frame):
    plan = plan_text(digest_turns(pieces(frame([], SCHEMA))))
    assert "Python" not in plan
    assert digest_turns(pieces(frame([], SCHEMA))).count() == 0


def test_digests_come_through_the_examples(spark, frame):
    """A context that is a character too long or short, of any example, shows in the digests."""
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "bb"), (1, 2, "user", "c"), (1, 3, "assistant", "dd"), (1, 4, "user", "e")]
    formatted = pieces(frame(rows, SCHEMA))
    digest = lambda df: {c: digest_turns(df).first()[c] for c in ("turns_sha256", "loss_sha256", "formatted_chars")}
    right = digest(formatted)
    for position, shift in ((1, 1), (1, -1), (3, 1), (3, -1)):
        off = formatted.withColumn("context_chars", F.when(F.col("position") == position, F.col("context_chars") + shift).otherwise(F.col("context_chars")))
        wrong = digest(off)
        assert wrong["loss_sha256"] != right["loss_sha256"]
        if position == 3:
            assert wrong["turns_sha256"] != right["turns_sha256"] and wrong["formatted_chars"] != right["formatted_chars"]
    # What examples() gives, written out, is what the digests read.
    flat = {r.position: r for r in materialise(formatted).collect()}
    assert hashlib.sha256("".join(flat[p].formatted[flat[p].loss_start:][:flat[p].loss_chars] for p in (1, 3)).encode()).hexdigest() == right["loss_sha256"]


def test_every_example_is_written_out_with_its_context(spark, frame):
    rows = [(1, 0, "user", "a\u00e9"), (1, 1, "assistant", "b<s>"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (1, 4, "user", "e"), (2, 0, "user", "x"), (None, 0, "assistant", "n")]
    formatted = pieces(frame(rows, SCHEMA))
    got = {(r.conv_id, r.position): r for r in expanded(formatted).collect()}
    assert set(got) == {(1, 1), (1, 3), (1, 4), (2, 0), (None, 0)}
    flat = {(r.conv_id, r.position): r for r in materialise(formatted).collect()}
    assert {k: (r.formatted, r.loss_start, r.loss_chars) for k, r in got.items() if r.loss_chars is not None} == {k: (r.formatted, r.loss_start, r.loss_chars) for k, r in flat.items()}
    whole = {r.conv_id: r.formatted for r in got.values() if r.whole}
    pieces_of = {}
    for r in formatted.orderBy("position").collect():
        pieces_of[r.conv_id] = pieces_of.get(r.conv_id, "") + r.piece
    assert whole == pieces_of and got[1, 4].loss_chars is None
    # The digests read these rows: the plan writes them out.
    assert "Generate" in plan_text(digest_turns(formatted))
