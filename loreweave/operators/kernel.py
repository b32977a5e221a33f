"""The in-task part of the batch vector search, on Arrow batches."""

from __future__ import annotations


def matcher(k: int, digits: int):
    """A function over one stream of vector batches: the k best ids per query.

    Similarities are rounded to ``digits`` decimals before they are compared.
    The function is built in here so that it travels to the executors by value
    and does not need this package there.
    """

    def match(batches, q_ids, q_matrix, q_cells):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        n_queries = len(q_ids)
        q_norm = np.sqrt((q_matrix * q_matrix).sum(axis=1))
        q_unit = q_matrix / np.where(q_norm > 0, q_norm, 1.0)[:, None]
        by_cell = {c: np.flatnonzero(q_cells == c) for c in np.unique(q_cells)}
        floor = np.full(n_queries, -np.inf)  # k-th best so far
        best = None

        def exact(v, v_norm, rows, queries):
            """Similarity of row/query pairs, each summed in the same order."""
            out = np.empty(len(rows))
            step = max(4_000_000 // v.shape[1], 1)
            with np.errstate(invalid="ignore", divide="ignore"):
                for i in range(0, len(rows), step):
                    r, q = rows[i : i + step], queries[i : i + step]
                    out[i : i + step] = (v[r] * q_matrix[q]).sum(axis=1) / (v_norm[r] * q_norm[q])
            return np.round(out, digits)

        def top(found):
            """The k best rows per query, equal similarities by id."""
            found = found.take(pc.sort_indices(found, sort_keys=[
                ("q", "ascending"), ("s", "descending"), ("id", "ascending")
            ]))
            q = found.column("q").to_numpy()
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            return found.filter(pa.array(rank < k))

        def few_equal(v, ids):
            """Rows without those that k equal vectors with smaller ids stand before."""
            same = np.ascontiguousarray(v).view(np.dtype((np.void, v.shape[1] * v.itemsize))).ravel()
            group = np.unique(same, return_inverse=True)[1]
            if len(group) <= k or np.bincount(group).max() <= k:
                return np.arange(len(v))
            order = pc.sort_indices(
                pa.table({"g": pa.array(group), "id": ids}), sort_keys=[("g", "ascending"), ("id", "ascending")]
            ).to_numpy()
            place = np.arange(len(order)) - np.searchsorted(group[order], group[order])
            return np.sort(order[place < k])

        def slices(batches):
            """Batches cut so that a float64 copy stays in the tens of megabytes."""
            for batch in batches:
                width = max(q_matrix.shape[1], 1)
                step = max(4_000_000 // width, 1)
                for i in range(0, batch.num_rows, step):
                    yield batch.slice(i, step)

        for batch in slices(batches):
            cells = batch.column("cell").to_numpy(zero_copy_only=False)
            widths = pc.unique(pc.list_value_length(batch.column("vector"))).to_pylist()
            if widths != [q_matrix.shape[1]]:
                raise ValueError(f"queries have width {q_matrix.shape[1]}, vectors have {widths}")
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            matrix = flat.reshape(batch.num_rows, -1).astype("float64")
            found = [] if best is None else [best]
            for cell in np.unique(cells):
                wanted = by_cell.get(cell)
                if wanted is None:
                    continue
                rows = np.flatnonzero(cells == cell)
                rows = rows[few_equal(matrix[rows], batch.column("id").take(pa.array(rows)))]
                blank = wanted[q_norm[wanted] == 0]
                if len(blank):
                    # A query of length zero is as near to one vector as to any other.
                    ids = batch.column("id").take(pa.array(rows))
                    first = ids.take(pc.sort_indices(ids).slice(0, k))
                    found.append(pa.table({
                        "q": pa.array(np.repeat(blank, len(first)), pa.int64()),
                        "s": pa.nulls(len(first) * len(blank), pa.float64()),
                        "id": pa.concat_arrays([first] * len(blank)),
                    }))
                    wanted = wanted[q_norm[wanted] > 0]
                v = matrix[rows]
                v_norm = np.sqrt((v * v).sum(axis=1))
                unit = v / np.where(v_norm > 0, v_norm, 1.0)[:, None]
                step = max(4_000_000 // len(v), 1)
                for i in range(0, len(wanted), step):
                    block = wanted[i : i + step]
                    # The product only picks candidates, with some slack.
                    rough = unit @ q_unit[block].T
                    rough[v_norm == 0] = -2.0
                    low = floor[block]
                    if len(v) > k:
                        low = np.maximum(low, np.partition(rough, len(v) - k, axis=0)[len(v) - k])
                    r, q = np.nonzero(rough >= low - 1e-9)
                    sims = exact(v, v_norm, r, block[q])
                    found.append(top(pa.table({
                        "q": pa.array(block[q], pa.int64()),
                        "s": pa.array(sims, pa.float64(), mask=np.isnan(sims)),
                        "id": batch.column("id").take(pa.array(rows[r])),
                    })))
            if not found:
                continue
            best = top(pa.concat_tables(found))
            q = best.column("q").to_numpy()
            last = np.flatnonzero(np.append(q[1:] != q[:-1], True)) if len(q) else q
            full = last[np.bincount(q, minlength=n_queries)[q[last]] >= k] if len(q) else q
            kth = best.column("s").fill_null(-2.0).to_numpy()[full]
            floor[q[full]] = kth

        if best is not None and best.num_rows:
            yield pa.table({
                "query_id": q_ids.take(best.column("q")),
                "id": best.column("id"),
                "similarity": best.column("s"),
            })

    return match
