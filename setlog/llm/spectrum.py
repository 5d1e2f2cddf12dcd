"""Leading eigenvectors of a symmetric matrix by spectrum slicing.

The inertia of the shifted matrix, read off an LDLᵀ factorisation (Sylvester's law), counts the eigenvalues
above the shift. Counts bisect until an interval holds one eigenvalue alone, Rayleigh quotient iteration
converges to it cubically, and two counts around the result certify its number. The matrix has as
many rows as vectors have dimensions and is worked on by the driver.
"""

import numpy as np

PIVOT = (1 + 17 ** 0.5) / 8  # of complete pivoting, which bounds the factors' growth
SETTLE = 3  # steps of inverse iteration before the Rayleigh quotient is the shift


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than ``shift``: positive pivots of LDLᵀ with pivots of one or two rows."""
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        p = int(diagonal.argmax())
        off = np.abs(a)
        np.fill_diagonal(off, 0)
        r, s = divmod(int(off.argmax()), len(a))
        if not diagonal[p] and not off[r, s]:
            return above
        if diagonal[p] >= PIVOT * off[r, s]:
            pivot, block = [p], np.array([[a[p, p]]])
            above += a[p, p] > 0
        else:  # its determinant is negative: one eigenvalue on each side
            pivot, block = [r, s], a[np.ix_([r, s], [r, s])]
            above += 1
        rest = np.delete(np.arange(len(a)), pivot)
        column = a[np.ix_(rest, pivot)]
        a = a[np.ix_(rest, rest)] - column @ np.linalg.solve(block, column.T)
    return above


def _iterated(matrix: np.ndarray, start: np.ndarray, shift: float, known: np.ndarray,
              low: float, high: float) -> tuple[float, np.ndarray] | None:
    """(eigenvalue, eigenvector) by Rayleigh quotient iteration from ``start``; None if it leaves
    the interval or doesn't settle."""
    scale = max(np.abs(matrix).max(), np.finfo(float).tiny)
    v, at = start, shift
    best = np.inf
    for step in range(30):
        try:
            w = np.linalg.solve(matrix - at * np.eye(len(matrix)), v)
        except np.linalg.LinAlgError:
            w = np.linalg.solve(matrix - (at + 4 * np.finfo(float).eps * scale) * np.eye(len(matrix)), v)
        most = np.abs(w).max()
        if not np.isfinite(most) or not most:
            break
        v = w / most
        v = v - known @ (known.T @ v)
        v /= np.linalg.norm(v)
        if step < SETTLE:  # inverse iteration by the middle of the interval first
            continue
        at = float(v @ matrix @ v)
        off = float(np.linalg.norm(matrix @ v - at * v))
        if off >= best and off <= 1e-12 * scale:
            break
        best = min(best, off)
    return (at, v) if best <= 1e-11 * scale * len(matrix) and low < at <= high else None


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues, falling, and their unit eigenvectors as columns; those that are 0 to
    rounding are left out.

    Where several eigenvalues are equal to rounding, any orthonormal vectors of theirs are given. Signs are
    such that the entry furthest from 0 is positive.
    """
    d = len(matrix)
    scale = float(np.abs(matrix).max(initial=0.0)) or 1.0
    matrix = (matrix + matrix.T) / 2 / scale
    trace = float(np.trace(matrix)) if d else 0.0
    zero = 8 * d * np.finfo(float).eps * trace
    if trace <= 0:
        return np.zeros(0), np.zeros((d, 0))
    n = min(most, count_above(matrix, zero))
    values, vectors = [], np.zeros((d, 0))
    close = 8 * max(d, 8) * np.finfo(float).eps * trace  # no nearer are eigenvalues told apart
    rng = np.random.default_rng(d)
    top = float(np.abs(matrix).sum(1).max())  # no eigenvalue is greater
    counts = {zero: count_above(matrix, zero), top: 0}  # what is known of the spectrum so far

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = count_above(matrix, shift)
        return counts[shift]
    for k in range(n):
        # The eigenvalue of number k + 1 lies between the nearest shifts known to enclose it.
        low = max(x for x, c in counts.items() if c > k)
        high = min(x for x, c in counts.items() if c <= k)
        found = None
        while found is None:
            alone = above(low) == k + 1 and above(high) == k
            tight = high - low <= close
            if alone or tight:
                start = rng.standard_normal(d)
                start -= vectors @ (vectors.T @ start)
                found = _iterated(matrix, start / np.linalg.norm(start), (low + high) / 2, vectors, low - close * tight, high + close)
                # Certified: it has number k + 1, or shares it within rounding.
                if found and not above(found[0] - close) > k >= above(found[0] + close):
                    found = None
                if found is None and tight:
                    raise ArithmeticError(f"eigenvalue {k + 1} doesn't settle")
            if found is None:
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) > k else (low, middle)
        at, v = found
        values.append(at)
        vectors = np.column_stack([vectors, v * np.sign(v[np.abs(v).argmax()])])
    return np.array(values) * scale, vectors
