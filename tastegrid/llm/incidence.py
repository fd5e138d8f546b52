"""Sparse 0/1 incidence matrices in compressed rows, and their products row by row."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Csr:
    """Row i holds the columns ``indices[indptr[i]:indptr[i + 1]]``."""

    indptr: np.ndarray
    indices: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def row_of(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(self.rows, dtype=np.int64), np.diff(self.indptr))

    def transposed(self) -> Csr:
        """Columns become rows; the entries of a new row keep the order of the old rows."""
        order = np.argsort(self.indices, kind="stable")
        indptr = np.zeros(self.columns + 1, dtype=np.int64)
        np.cumsum(np.bincount(self.indices, minlength=self.columns), out=indptr[1:])
        return Csr(indptr, self.row_of()[order], self.rows)


def covering(ends: np.ndarray) -> Csr:
    """Token-byte incidence: token i covers the bytes from the end of token i - 1 to ``ends[i]``."""
    total = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]).astype(np.int64), np.arange(total, dtype=np.int64), total)


def member(group: np.ndarray, groups: int) -> Csr:
    """Token-group incidence: every token lies in one group."""
    return Csr(np.arange(len(group) + 1, dtype=np.int64), group.astype(np.int64), groups)


def product_sizes(left: Csr, right: Csr) -> np.ndarray:
    """Products met in each row of ``left @ right``: the symbolic half of Gustavson's method."""
    met = np.diff(right.indptr)[left.indices]
    sums = np.zeros(len(met) + 1, dtype=np.int64)
    np.cumsum(met, out=sums[1:])
    return sums[left.indptr[1:]] - sums[left.indptr[:-1]]


def product(left: Csr, right: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of ``left @ right``, by row, then column.

    Gustavson: row i of the product is the sum of the rows of ``right`` that
    row i of ``left`` names.  All rows are expanded at once and equal cells
    added up; cells that already come in order are not sorted.
    """
    starts = right.indptr[left.indices]
    met = right.indptr[left.indices + 1] - starts
    row = np.repeat(left.row_of(), met)
    base = np.zeros(len(met) + 1, dtype=np.int64)
    np.cumsum(met, out=base[1:])
    column = right.indices[np.arange(base[-1]) - np.repeat(base[:-1] - starts, met)]
    cell = row * right.columns + column
    if not len(cell):
        return cell, cell, cell
    if np.any(cell[1:] < cell[:-1]):
        cell.sort()
    heads = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    value = np.diff(np.append(heads, len(cell)))
    return cell[heads] // right.columns, cell[heads] % right.columns, value
