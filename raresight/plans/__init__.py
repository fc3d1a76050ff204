from raresight.plans.boosting import BoostedTrees, boosted_trees
from raresight.plans.cumulative import cumulative_by_value
from raresight.plans.neighbours import exact_knn
from raresight.plans.newton import LogisticFit, logistic_gradient, newton_logistic
from raresight.plans.ordering import exact_quantiles, hash_rank, hash_rank_cutoffs

__all__ = ["BoostedTrees", "LogisticFit", "boosted_trees", "cumulative_by_value", "exact_knn", "exact_quantiles", "hash_rank", "hash_rank_cutoffs", "logistic_gradient", "newton_logistic"]
