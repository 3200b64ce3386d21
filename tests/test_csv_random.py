"""Random cells, written by Python's csv module and read back by Spark."""

import csv
import random

import pytest

from eventweir.sources.csv_files import read_click_csv


@pytest.mark.parametrize("alphabet", [',"x é\\\'#;|', ',"x\n', ',"x\r\n \t', '"\r\n'])
@pytest.mark.parametrize("row_end", ["\n", "\r\n"])
@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
def test_random_cells(spark, tmp_path, alphabet, row_end, quoting):
    rng = random.Random(f"{alphabet}{row_end}{quoting}")
    rows = []
    for _ in range(1500):
        cells = ["".join(rng.choices(alphabet, k=rng.choice([0, 1, 2, 5]))) for _ in range(4)]
        rows.append(cells)
    path = tmp_path / "cells.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=row_end, quoting=quoting).writerows(rows)
    with open(path, newline="", encoding="utf-8") as f:
        assert list(csv.reader(f)) == rows
    names = ["sessionId", "timestamp", "itemId", "category"]
    got = [[r[n] for n in names] for r in read_click_csv(spark, str(path)).collect()]
    assert got == rows
