"""Public tokenizers inside Python workers."""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Callable, Iterator, Sequence
from typing import Any


def vocabulary(name: str) -> str:
    """Path of an installed vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def kept(key: object, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once for all tasks that a Python worker runs."""
    name = "_kept_by_worker"
    held = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def _json_encoder(path: str, plain: bool):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    if plain:
        tokenizer.encode_special_tokens = True

    def encode(texts: Sequence[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)]

    return tokenizer, encode


def _piece_encoder(path: str):
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(texts: Sequence[str]) -> list[list[int]]:
        return pieces.encode(list(texts), num_threads=1)

    return pieces, encode


def encoder(path: str, plain: bool = False):
    """(tokenizer, encode) of a .json or .model file; ``encode`` turns texts into lists of ids.

    No begin, end or other special token is added. Special strings inside a text are handled as the
    library does by default, or as ordinary text with ``plain``.
    """
    if path.endswith(".model"):
        return kept((path, plain), lambda: _piece_encoder(path))
    return kept((path, plain), lambda: _json_encoder(path, plain))


def version(path: str) -> str:
    """Digest of all that a tokenizer's results depend on: its file, its library and the options."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as f:
        file = hashlib.sha256(f.read()).hexdigest()
    said = f"{library.__name__} {library.__version__} without special tokens {file}"
    return hashlib.sha256(said.encode()).hexdigest()


def by_size(texts: Sequence[str], most: int = 1_000_000) -> Iterator[list[str]]:
    """Runs of texts of about ``most`` characters, a longer text being a run of its own."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > most:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run
