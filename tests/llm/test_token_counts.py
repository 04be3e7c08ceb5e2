"""Operator 5 on control characters, at several hash seeds of the interpreter."""

import os
import subprocess
import sys

import pytest

P = pytest.importorskip("public_tokenizers")
pytest.importorskip("sentencepiece")

SCRIPT = r"""
import random, sys
import sentencepiece, public_tokenizers as P
from permitflow.llm.bpe import PieceCounter
path = P.path("piece_bpe_32k.model")
model, own, rng = sentencepiece.SentencePieceProcessor(model_file=path), PieceCounter(path), random.Random(int(sys.argv[1]))
parts = ["a", "page one", "two", " ", "  ", "\t", "\n", "\r", "\r\n", "\x0b", "\x0c", "\x00", "\x1c", "\x85", " ", "▁", "é", "你", "."]
texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(20_000)] + ["a\x0cb", "page one\x0cpage two", "\x0c", "\n\x0c\t"]
wrong = [t for t in texts if own.count(t) != len(model.encode(t))]
sys.exit(f"{len(wrong)} wrong: {wrong[:5]!r}" if wrong else 0)
"""


@pytest.mark.parametrize("seed", ["0", "2", "5", "7"])
def test_control_characters(seed):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {**os.environ, "PYTHONHASHSEED": seed, "PYTHONPATH": os.pathsep.join([root, os.environ.get("PYTHONPATH", "")])}
    done = subprocess.run([sys.executable, "-c", SCRIPT, seed], env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-600:]
