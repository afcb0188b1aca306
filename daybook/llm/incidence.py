"""Incidence matrices in compressed rows, and their products row by row (Gustavson)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Csr:
    """A matrix of ones: row r has them in the columns indices[indptr[r]:indptr[r + 1]]."""

    indptr: np.ndarray
    indices: np.ndarray
    n_columns: int

    @property
    def n_rows(self) -> int:
        return len(self.indptr) - 1

    def rows(self, first: int, last: int) -> "Csr":
        start, end = self.indptr[first], self.indptr[last]
        return Csr(self.indptr[first : last + 1] - start, self.indices[start:end], self.n_columns)

    def transposed(self) -> "Csr":
        order = np.argsort(self.indices, kind="stable")
        owner = np.repeat(np.arange(self.n_rows), np.diff(self.indptr))
        sizes = np.bincount(self.indices, minlength=self.n_columns)
        return Csr(np.r_[0, np.cumsum(sizes)], owner[order], self.n_rows)


def of_ranges(ends: np.ndarray, n_columns: int) -> Csr:
    """Rows that cover consecutive ranges of the columns; ``ends`` are the ends of the ranges."""
    return Csr(np.r_[0, ends], np.arange(ends[-1] if len(ends) else 0), n_columns)


def of_labels(labels: np.ndarray, n_columns: int) -> Csr:
    """Rows with a single one, in the column that ``labels`` names."""
    return Csr(np.arange(len(labels) + 1), labels, n_columns)


def product(a: Csr, b: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of a·b, in order of row and column.

    Each one of a row of ``a`` in column k adds row k of ``b`` to that row of the product; what falls
    on the same cell is summed.
    """
    widths = np.diff(b.indptr)[a.indices]
    row = np.repeat(np.repeat(np.arange(a.n_rows), np.diff(a.indptr)), widths)
    first = np.repeat(b.indptr[a.indices] - np.r_[0, np.cumsum(widths)[:-1]], widths) if len(widths) else widths
    column = b.indices[first + np.arange(len(row))]
    cell = row * b.n_columns + column
    if len(cell) > 1 and (cell[1:] < cell[:-1]).any():
        cell = np.sort(cell)
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else cell
    values = np.diff(np.r_[starts, len(cell)])
    cell = cell[starts]
    return cell // max(b.n_columns, 1), cell % max(b.n_columns, 1), values


def products(a: Csr, b: Csr, most_cells: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The product in blocks of rows, so that none sums more than about ``most_cells`` before merging."""
    work = np.r_[0, np.cumsum(np.diff(b.indptr)[a.indices])][a.indptr]  # cells before each row
    first = 0
    while first < a.n_rows:
        last = max(first + 1, int(np.searchsorted(work, work[first] + most_cells, "right")) - 1)
        row, column, value = product(a.rows(first, last), b)
        yield row + first, column, value
        first = last
