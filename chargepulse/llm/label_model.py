"""Weak supervision on the driver, over bounded tables of votes: a generative label model
(reliabilities by expectation-maximisation, correlated voters sharing their weight) and
a logistic classifier trained on its posterior labels."""

from __future__ import annotations

import numpy as np


def shared_weights(votes: np.ndarray, weight: np.ndarray, post: np.ndarray, limit: float = 0.3) -> np.ndarray:
    """Weight of each voter: one over the effective number of voters that say the same.

    Correlations are of what the class leaves unexplained (residuals given the posterior).
    """
    resid = votes.astype(np.float32)
    for p in (post, 1 - post):
        w = weight * p
        resid -= np.outer(p, (w @ votes) / max(w.sum(), 1e-9)).astype(np.float32)
    resid *= np.sqrt(weight)[:, None].astype(np.float32)
    cov = (resid.T @ resid).astype(np.float64) / max(weight.sum(), 1e-9)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    return 1 / (1 + np.where(corr > limit, corr, 0).sum(1))


def label_model(votes: np.ndarray, weight: np.ndarray, start: np.ndarray, prior: np.ndarray | None = None,
                rounds: int = 30) -> np.ndarray:
    """Posterior of class 1 for each row of votes in {-1, 0, 1} (0: abstains), rows weighted.

    Each voter has, per class, a rate of each of its answers; an abstention says nothing, so
    one reliable vote is not outweighed by many voters that look for something else.  ``start``
    is the first guess of the posterior; ``prior`` is what else is known of each row (default: the
    share of class 1, estimated).  Two passes: first voters that say nearly the same share one
    vote, then voters weigh by what they add to the posterior.
    """
    post, share = np.clip(start, 0.02, 0.98), shared_weights(votes, weight, np.full(len(votes), 0.5), 0.8)
    known = None if prior is None else np.log(np.clip(prior, 1e-6, 1 - 1e-6))
    opposed = None if prior is None else np.log1p(-np.clip(prior, 1e-6, 1 - 1e-6))
    yes, no = (votes > 0).astype(np.float32), (votes < 0).astype(np.float32)
    for again in range(2):
        for _ in range(rounds):
            log = []
            for p, held in ((1 - post, opposed), (post, known)):
                w = weight * p
                total = w.sum()
                for_, against = (w.astype(np.float32) @ yes).astype(np.float64), (w.astype(np.float32) @ no).astype(np.float64)
                table = np.log((np.stack([against, for_]) + 0.5) / (total + 1.5)) * share
                log.append((np.log((total + 1) / (weight.sum() + 2)) if held is None else held) + yes @ table[1] + no @ table[0])
            new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -40, 40)))
            if np.abs(new - post).max(initial=0) < 1e-6:
                break
            post = new
        if not again:
            share = shared_weights(votes, weight, post)
    return post


def logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Coefficients (the last is the intercept) by Newton steps on soft targets."""
    z = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    pen = np.full(z.shape[1], ridge)
    pen[-1] = 1e-3
    beta = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        grad = z.T @ (weight * (target - p)) - pen * beta
        hess = (z * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ z + np.diag(pen)
        step = np.linalg.solve(hess, grad)
        beta = beta + step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return beta
