"""DataFrame-to-DataFrame operators.

A *series* is a DataFrame with the key columns (possibly none) and
``ts, idx, n, y``: bucket start, position in the series from 0, length of the
series, value. Series are free of gaps, so ``idx`` replaces every row number and
``n`` every count.
"""
