"""DuckDB SQL text for the oracle side of the catalogue.

These helpers only build SQL strings that DuckDB runs on the same Parquet
tables; they mirror the Column expressions of ``functions.losses`` term by
term so that both sides do the same floating-point operations per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from ..sources.fixtures import duck_sql


def D(v: float) -> str:
    """A DOUBLE literal (plain DuckDB numerals are DECIMAL)."""
    return f"CAST({float(v)!r} AS DOUBLE)"


def R(expr: str, digits: int = 6) -> str:
    """floor(x·10^k + 0.5)/10^k, the exact rounding used on the Spark side."""
    scale = D(10.0**digits)
    return f"(floor(CAST({expr} AS DOUBLE) * {scale} + {D(0.5)}) / {scale})"


def margin(weights: Sequence[float], feats: Sequence[str]) -> str:
    acc = None
    for w, x in zip(weights, feats):
        term = f"({D(w)} * {x})"
        acc = term if acc is None else f"({acc} + {term})"
    return acc


def pointwise(loss: str, z: Sequence[str], y: str) -> tuple[str, list[str]]:
    """(loss, [dloss_c]) SQL for the built-in losses, same form as the Columns."""
    if loss == "logistic":
        m = f"({y} * {z[0]})"
        return (
            f"(greatest(-{m}, {D(0)}) + ln(1 + exp(-abs({m}))))",
            [f"(-{y} / (exp({m}) + {D(1)}))"],
        )
    if loss == "hinge":
        m = f"({y} * {z[0]})"
        l = f"greatest({D(0)}, {D(1)} - {m})"
        return l, [f"(CASE WHEN {l} > 0 THEN -{y} ELSE {D(0)} END)"]
    if loss == "squared":
        r = f"({z[0]} - {y})"
        return f"({D(0.5)} * {r} * {r})", [r]
    if loss == "quadratic":  # the user loss of the G1 query: (z - y)², derivative 2 (z - y)
        r = f"({z[0]} - {y})"
        return f"({r} * {r})", [f"({D(2)} * {r})"]
    if loss == "softmax":
        mx = f"greatest({', '.join(z)})" if len(z) > 1 else z[0]
        tot = " + ".join(f"exp({zc} - {mx})" for zc in z)
        lse = f"({mx} + ln({tot}))"
        picked = "CASE " + " ".join(f"WHEN {y} = {c} THEN {zc}" for c, zc in enumerate(z)) + " END"
        dl = [f"(exp({zc} - {lse}) - CASE WHEN {y} = {c} THEN {D(1)} ELSE {D(0)} END)" for c, zc in enumerate(z)]
        return f"({lse} - ({picked}))", dl
    raise KeyError(loss)


def feats_of(d: int) -> list[str]:
    return [f"x{j + 1}" for j in range(d)]


def loss_grad_long(
    fixture: str, loss: str, W: Sequence[Sequence[float]], reduce: str = "mean", pen_score: float = 0.0, pen_grad=None
) -> str:
    """Long-form loss/gradient aggregate, as ``operators.loss_grad.loss_grad_long``."""
    C = len(W)
    d = len(W[0])
    feats = feats_of(d)
    zs = [margin(W[c], feats) for c in range(C)]
    zcols = ", ".join(f"{zs[c]} AS z{c}" for c in range(C))
    l, dl = pointwise(loss, [f"z{c}" for c in range(C)], "label")
    dcols = ", ".join(f"{dl[c]} AS d{c}" for c in range(C))
    gsums = ", ".join(f"sum(d{c} * x{j + 1}) AS g_{c}_{j + 1}" for c in range(C) for j in range(d))
    scale = "/ n" if reduce == "mean" else ""
    parts = []
    for c in range(C):
        for j in range(d):
            pg = 0.0 if pen_grad is None else float(pen_grad[c][j])
            parts.append(
                f"SELECT n, {R(f'loss {scale} + {D(pen_score)}')} AS loss, {c} AS class_id, {j + 1} AS feature_id, "
                f"{R(f'g_{c}_{j + 1} {scale} + {D(pg)}')} AS grad FROM agg"
            )
    return (
        f"WITH p AS ({duck_sql(fixture)}), "
        f"z AS (SELECT {', '.join(feats)}, label, {zcols} FROM p), "
        f"pw AS (SELECT {', '.join(feats)}, {l} AS l, {dcols} FROM z), "
        f"agg AS (SELECT count(*) AS n, sum(l) AS loss, {gsums} FROM pw) "
        + " UNION ALL ".join(parts)
    )


# --- fixed-K fits as recursive CTEs -------------------------------------------------


class FitSQL:
    """A fixed-K first-order fit written as one DuckDB recursive CTE.

    ``data='rows'`` aggregates the loss over the fixture rows at every step;
    ``data='moments'`` computes the second moments once and iterates on them
    (squared loss). ``step`` is 'prox_l2', 'prox_l1', 'prox_group',
    'project_box' or 'none'; ``accelerated`` adds the momentum state.
    The CTE ``it`` holds (k, w_c_j..., fprev, dnorm): row k+1 carries the
    objective at the point evaluated in step k and ‖w_{k+1} − w_k‖.
    """

    def __init__(self, fixture, loss, C, d, K, w0, step, lam=0.0, lr=1.0, decay=False, groups=None,
                 threshold="exact", data="rows", accelerated=False, momentum="published", lambdas=None,
                 tol=1e-6, box=(0.0, 1.0)):
        self.fixture, self.loss, self.C, self.d, self.K = fixture, loss, C, d, K
        self.w0 = [[float(v) for v in row] for row in w0]
        self.step, self.lam, self.lr, self.decay = step, lam, lr, decay
        self.groups, self.threshold, self.data = groups or [], threshold, data
        self.acc, self.momentum = accelerated, momentum
        self.box = box  # bounds of 'project_box'
        self.lambdas = lambdas  # several λ chains at once (column 'lam')
        self.tol = tol  # stop a chain once ‖Δw‖ < tol, as the trainers do
        self.W = [[f"w_{c}_{j + 1}" for j in range(d)] for c in range(C)]
        self.flat = [w for row in self.W for w in row]
        self.feats = feats_of(d)

    # pieces -------------------------------------------------------------
    def _lam(self):
        return "lam" if self.lambdas else D(self.lam)

    def _eta(self, k="k"):
        return f"({D(self.lr)} / sqrt({k} + 1))" if self.decay else D(self.lr)

    def _score(self, cols):
        if self.step == "prox_l2":
            return f"(({' + '.join(f'({c} * {c})' for c in cols)}) / 2.0)"
        if self.step == "prox_l1":
            return f"({' + '.join(f'abs({c})' for c in cols)})"
        if self.step == "prox_group":
            parts = [f"sqrt({' + '.join(f'({cols[j - 1]} * {cols[j - 1]})' for j in g)})" for g in self.groups]
            return f"({' + '.join(parts)})"
        return D(0)

    def _moments_cte(self):
        cols = ["label"] + self.feats
        sums = [f"sum({cols[i]} * {cols[j]}) AS m_{i}_{j}" for i in range(len(cols)) for j in range(i, len(cols))]
        return f"mm AS MATERIALIZED (SELECT count(*) AS n, {', '.join(sums)} FROM p)"

    def _m(self, i, j):
        a, b = (i, j) if i <= j else (j, i)
        return f"m_{a}_{b}"

    def _agg_select(self, point_cols, where):
        """SELECT of n, ls (loss sum) and g_c_j (gradient sums) at the point columns."""
        if self.data == "moments":
            w = point_cols
            xtxw = [
                "(" + " + ".join(f"({self._m(j + 1, i + 1)} * {w[i]})" for i in range(self.d)) + ")"
                for j in range(self.d)
            ]
            y = [f"y_{j + 1}" for j in range(self.d)]
            wxtxw = " + ".join(f"({w[j]} * {y[j]})" for j in range(self.d))
            wxty = " + ".join(f"({w[j]} * {self._m(j + 1, 0)})" for j in range(self.d))
            ls = f"({D(0.5)} * ((({wxtxw}) - (2.0 * ({wxty}))) + m_0_0))"
            grads = ", ".join(f"({y[j]} - {self._m(j + 1, 0)}) AS g_0_{j + 1}" for j in range(self.d))
            heads = ", ".join(self._m(j, 0) for j in range(self.d + 1))
            state = ", ".join(self._state_cols())
            inner = (f"SELECT {', '.join(f'it.{c}' for c in self._state_cols())}, n, {heads}, "
                     f"{', '.join(f'{e} AS {a}' for e, a in zip(xtxw, y))} FROM it, mm WHERE {where}")
            return f"SELECT {state}, n, {ls} AS ls, {grads} FROM ({inner}) q"
        rows = [point_cols[c * self.d:(c + 1) * self.d] for c in range(self.C)]
        zs = [margin_cols(rows[c], self.feats) for c in range(self.C)]
        l, dl = pointwise(self.loss, [f"z_{c}" for c in range(self.C)], "label")
        own = [f"it.{c}" for c in self._state_cols()]
        x = ", ".join(self.feats)
        z = ", ".join(f"{e} AS z_{c}" for c, e in enumerate(zs))
        inner = f"SELECT {', '.join(own)}, {x}, label, {z} FROM it, p WHERE {where}"
        inner = f"SELECT *, {l} AS l_, {', '.join(f'{e} AS d_{c}' for c, e in enumerate(dl))} FROM ({inner}) q1"
        grads = ", ".join(f"sum(d_{c} * x{j + 1}) AS g_{c}_{j + 1}" for c in range(self.C) for j in range(self.d))
        keys = ["k"] + (["lam"] if self.lambdas else [])
        rest = ", ".join(f"any_value({c}) AS {c}" for c in self._state_cols() if c not in keys)
        return f"SELECT {', '.join(keys)}, {rest}, count(*) AS n, sum(l_) AS ls, {grads} FROM ({inner}) q2 GROUP BY {', '.join(keys)}"

    def _state_cols(self):
        cols = ["k"] + (["lam"] if self.lambdas else []) + self.flat
        if self.acc:
            cols += ["co"] + [f"t_{w}" for w in self.flat]
        return cols + ["fprev", "dnorm"]

    def _new_weights(self, v):
        lam, t = self._lam(), f"({self._eta()} * {self._lam()})"
        if self.step == "prox_l2":
            return [f"({x} / (1.0 + {t}))" for x in v]
        if self.step == "prox_l1":
            return [f"(CASE WHEN abs({x}) < {t} THEN {D(0)} ELSE ({x} - (sign({x}) * {t})) END)" for x in v]
        if self.step == "project_box":
            return [f"greatest({D(self.box[0])}, least({D(self.box[1])}, {x}))" for x in v]
        if self.step == "prox_group":
            out = list(v)
            for gi, g in enumerate(self.groups):
                nrm = f"gn{gi}"
                lim = f"({t} * sqrt({len(g)}))" if self.threshold == "sqrt_size" else t
                for j in g:
                    x = v[j - 1]
                    out[j - 1] = f"(CASE WHEN {nrm} <= {lim} THEN {D(0)} ELSE ({x} * (({nrm} - {t}) / {nrm})) END)"
            return out
        return list(v)

    def cte(self) -> str:
        """``WITH RECURSIVE p AS (...), [mm AS (...),] it AS (...)``."""
        init = ["0 AS k"] + ([] if not self.lambdas else ["lam"])
        init += [f"{D(self.w0[c][j])} AS {self.W[c][j]}" for c in range(self.C) for j in range(self.d)]
        if self.acc:
            init += [f"{D(1)} AS co"] + [f"{D(self.w0[c][j])} AS t_{self.W[c][j]}" for c in range(self.C) for j in range(self.d)]
        init += ["CAST(NULL AS DOUBLE) AS fprev", "CAST(NULL AS DOUBLE) AS dnorm"]
        base = f"SELECT {', '.join(init)}"
        if self.lambdas:
            base += " FROM (VALUES " + ", ".join(f"({D(l)})" for l in self.lambdas) + ") AS L(lam)"
        point = [f"t_{w}" for w in self.flat] if self.acc else self.flat
        cond = f"k < {self.K}"
        if self.tol is not None:
            cond += f" AND (dnorm IS NULL OR dnorm >= {D(self.tol)})"
        agg = self._agg_select(point, cond)
        v = [f"({pc} - ({self._eta()} * (g_{c}_{j + 1} / n)))"
             for (pc, (c, j)) in zip(point, [(c, j) for c in range(self.C) for j in range(self.d)])]
        vnames = [f"v_{w}" for w in self.flat]
        lvl1 = (f"SELECT *, {', '.join(f'{e} AS {nm}' for e, nm in zip(v, vnames))}, "
                f"((ls / n) + ({self._lam()} * {self._score(point)})) AS fnew FROM ({agg}) a")
        norms = ", ".join(
            f"sqrt({' + '.join(f'({vnames[j - 1]} * {vnames[j - 1]})' for j in g)}) AS gn{gi}"
            for gi, g in enumerate(self.groups)
        )
        lvl2 = f"SELECT *{', ' + norms if norms else ''} FROM ({lvl1}) b"
        neww = self._new_weights(vnames)
        nw = [f"nw_{w}" for w in self.flat]
        lvl3 = f"SELECT *, {', '.join(f'{e} AS {n}' for e, n in zip(neww, nw))} FROM ({lvl2}) c2"
        out = ["k + 1"] + (["lam"] if self.lambdas else []) + nw
        if self.acc:
            base_c = "1.0" if self.momentum == "published" else "0.0"
            nco = f"(({base_c} + sqrt(1.0 + ((4.0 * co) * co))) / 2.0)"
            out += [nco]
            out += [f"({n} + (({n} - {w}) * ((co - 1.0) / {nco})))" for n, w in zip(nw, self.flat)]
        out += ["fnew", f"sqrt({' + '.join(f'(({n} - {w}) * ({n} - {w}))' for n, w in zip(nw, self.flat))})"]
        rec = f"SELECT {', '.join(out)} FROM ({lvl3}) c3"
        cols = ", ".join(self._state_cols())
        mm = f", {self._moments_cte()}" if self.data == "moments" else ""
        return f"WITH RECURSIVE p AS MATERIALIZED ({duck_sql(self.fixture)}){mm}, it({cols}) AS ({base} UNION ALL {rec})"

    def last(self) -> str:
        """Predicate selecting the last iterate of each chain."""
        if self.tol is None:
            return f"k = {self.K}"
        if self.lambdas:
            return "k = (SELECT max(i2.k) FROM it i2 WHERE i2.lam = it.lam)"
        return "k = (SELECT max(i2.k) FROM it i2)"

    def final_cte(self) -> str:
        """Adds ``fin``: objective at the last iterate (per λ chain)."""
        agg = self._agg_select(self.flat, self.last())
        return (f"{self.cte()}, fin AS (SELECT {'lam, ' if self.lambdas else ''}"
                f"((ls / n) + ({self._lam()} * {self._score(self.flat)})) AS f FROM ({agg}) a)")

    def model_sql(self, digits=6, status=True) -> str:
        """The model table at the last iterate, with the number of iterations and the status."""
        entries = ", ".join(
            f"{{'c': {c}, 'j': {j + 1}, 'w': {R(self.W[c][j], digits)}}}" for c in range(self.C) for j in range(self.d)
        )
        extra = (f", CAST(k AS INTEGER) AS iterations, CASE WHEN dnorm < {D(self.tol)} THEN 'converged' ELSE 'max_iter' END "
                 f"AS status") if status else ""
        return (
            f"{self.cte()} SELECT 0 AS model_id, CAST(e.c AS INTEGER) AS class_id, CAST(e.j AS INTEGER) AS feature_id, "
            f"e.w AS weight{', iterations, status' if status else ''} "
            f"FROM (SELECT unnest([{entries}]) AS e{extra} FROM (SELECT * FROM it ORDER BY k DESC LIMIT 1) f) u"
        )

    def trace_sql(self, run_id: str, with_eval_point: bool = False) -> str:
        eta = f"({D(self.lr)} / sqrt(k))" if self.decay else D(self.lr)
        ep_step = f", '{'extrapolated' if self.acc else 'current'}' AS eval_point" if with_eval_point else ""
        ep_last = ", 'current' AS eval_point" if with_eval_point else ""
        steps = (f"SELECT '{run_id}' AS run_id, CAST(k - 1 AS INTEGER) AS iter, {R('fprev')} AS loss, "
                 f"{R(eta)} AS eta, {R('dnorm')} AS norm{ep_step} FROM it WHERE k >= 1")
        last = (f"SELECT '{run_id}' AS run_id, CAST((SELECT max(k) FROM it) AS INTEGER) AS iter, {R('f')} AS loss, "
                f"CAST(NULL AS DOUBLE) AS eta, CAST(NULL AS DOUBLE) AS norm{ep_last} FROM fin")
        return f"{self.final_cte()} {steps} UNION ALL {last}"


def margin_cols(wcols: Sequence[str], feats: Sequence[str]) -> str:
    acc = None
    for w, x in zip(wcols, feats):
        term = f"({w} * {x})"
        acc = term if acc is None else f"({acc} + {term})"
    return acc


def trace_cte(fit: FitSQL) -> str:
    """``fit.final_cte()`` plus ``tr(iter, loss, w_c_j...)``: row t holds w_t and the objective at w_t."""
    ws = ", ".join(f"it.{w}" for w in fit.flat)
    return (
        f"{fit.final_cte()}, tr AS (SELECT CAST(it.k AS INTEGER) AS iter, "
        f"COALESCE(nx.fprev, (SELECT f FROM fin)) AS loss, {ws} FROM it LEFT JOIN it nx ON nx.k = it.k + 1)"
    )
