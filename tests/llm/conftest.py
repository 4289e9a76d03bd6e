import random

import pytest

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="session")
def model():
    with open(MODEL, "rb") as f:
        return f.read()


@pytest.fixture(scope="session")
def hard_rows():
    """(doc_id, text) rows with nulls, empty and long texts, ties, repeated rows, copies, near copies and shared passages."""
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdeéüñ") for _ in range(rng.randint(2, 7))) for _ in range(400)]

    def prose(n):
        w = [rng.choice(vocab) for _ in range(n)]
        for i in range(7, n, 9):
            w[i] = w[i] + "."
        return " ".join(w).capitalize() + "."

    base, passage = prose(150), prose(60)
    rows = [(None, None), (None, "No id here. " + prose(20)), (1, None), (2, ""), (3, "   \n\t "), (4, "One."), (5, "One."), (6, "one.  two three"), (7, "One.\x00two three")]
    rows += [(10, base), (11, base), (11, base), (12, base + " Extra tail words here."), (13, base.replace(" ", "\n", 3))]
    words = base.split(" ")
    for k in range(20):  # near copies around the threshold
        w = list(words)
        for _ in range(k // 2 + 1):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((20 + k, " ".join(w)))
    rows += [(60 + k, f"{prose(30)} {passage} {prose(40)}") for k in range(15)]
    rows += [(80, prose(30) + " x" + "é" * 150 + "y " + prose(5)), (81, prose(10) + " z" + "é" * 150 + "w " + prose(5))]
    rows += [(90, "ab " * 3000), (91, prose(4000)), (92, "menu home\nAccept cookies now. Read it.\nFOO BAR BAZ!!\n" + prose(40))]
    rows += [(93, "| a | b | c\n" + prose(12)), (94, "x x x x x x\n" + prose(12)), (95, passage)]
    return rows


@pytest.fixture(scope="session")
def hard_docs(spark, hard_rows):
    """The rows as a table of documents, over several partitions, with columns that the operators also make."""
    made = [(i, t, "en", "src0", len(t or ""), "kept?", "spans") for i, t in hard_rows]
    return spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long, note string, _spans string").repartition(5)


@pytest.fixture(scope="session")
def no_docs(hard_docs):
    return hard_docs.where("doc_id < -1")
