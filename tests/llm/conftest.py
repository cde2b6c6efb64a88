import random

import pytest

from mastermill.llm.queries import tokenizer_path

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "re", "so", "ti", "va") for b in ("", "ban", "dor", "fel", "gim", "hus")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(random_, n):
    return " ".join(random_.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def path():
    return tokenizer_path()


@pytest.fixture(scope="session")
def texts():
    """Texts with copies, near copies, shared passages, repeats, and the odd cases."""
    r = random.Random(7)
    base = ["\n".join(sentence(r, r.randint(5, 30)) for _ in range(r.randint(1, 9))) for _ in range(30)]
    shared = "\n".join(sentence(r, 25) for _ in range(4))
    out = [*base, *base[:5], *[b + "\n" + shared for b in base[5:12]]]
    out += [b.replace(" ", " nubanx ", 1) for b in base[12:20]]
    out += [None, "", " ", "\n\n", "a", "ka lo", "ka lo", "x" * 3000, "a  b\n\n c ", "ab " * 2000, "é è\u00a0ü\u3000z 你好", "<|endoftext|> word"]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, ("en", "de", None)[i % 3], "src0" if i % 3 else None, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
