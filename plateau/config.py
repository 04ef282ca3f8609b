"""Configuration of the pipeline.

The constants under "fixed values" must equal the reference's for equal results;
they are stated plainly and together here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's)
# ---------------------------------------------------------------------------

# Engagement weight of each interaction event.
INTERACTION_WEIGHTS: dict[str, float] = {
    "Recipe Viewed": 1.0,
    "Recipe Link Clicked": 2.0,
    "Recipe Favourited": 4.0,
    "Recipe Cooked": 5.0,
    "Recipe Cook Started": 3.0,
    "Recipe Added To Collections": 3.5,
    "Recipe Removed From Collections": -2.0,
    "Recipe Search Queried": 0.5,
}

# Event-name replacements of the event cleaner; NULL or empty -> "Unknown Event".
EVENT_NAME_MAP: dict[str, str] = {
    "$ae_first_open": "First Open",
    "$ae_session": "Session",
    "$identify": "User Identified",
}
UNKNOWN_EVENT = "Unknown Event"

# Event sets used by the exploration report and the fetchers.
RECIPE_EVENTS = [
    "Recipe Viewed", "Recipe Link Clicked", "Recipe Favourited", "Recipe Cooked",
    "Recipe Cook Started", "Recipe Added To Collections",
    "Recipe Removed From Collections", "Recipe Search Queried",
]
# The exploration report's recipe set (adds two filter events) and ingredient set.
EDA_RECIPE_EVENTS = [
    "Recipe Viewed", "Recipe Cooked", "Recipe Favourited", "Recipe Link Clicked",
    "Recipe Added To Collections", "Recipe Removed From Collections", "Recipe Cook Started",
    "Recipe Search Queried", "Recipe Search Filter Applied", "Recipe Filter Applied",
]
INGREDIENT_EVENTS = [
    "Pantry Item Added", "Pantry Item Removed", "Pantry Items Added", "Grocery Item Added",
    "Grocery Item Removed", "Grocery Items Added", "Custom Ingredient Added",
    "Custom Ingredients Added",
]
# Event set of the item reconciliation job.
RECONCILE_EVENTS = [
    "Recipe Viewed", "Recipe Cooked", "Recipe Link Clicked", "Recipe Favourited",
    "Recipe Unfavourited",
]
# Activity threshold of the insights report.
ACTIVE_USER_MIN_EVENTS = 5
FUNNEL_STEPS = ["Recipe Viewed", "Recipe Favourited", "Recipe Cooked"]

# User segments by event count: (upper bound inclusive, name); above the last -> "Power".
USER_SEGMENTS = [(1, "One-time User"), (5, "Light User"), (20, "Moderate User"), (50, "Active User")]
USER_SEGMENT_TOP = "Power User"

# Interaction-count buckets of the exploration report.
ENGAGEMENT_BUCKETS = [(1, 1, "1"), (2, 5, "2-5"), (6, 10, "6-10"), (11, None, ">10")]

# Event version defaults.
V1_DEFAULT_PLATFORM = "ios"
V1_DEFAULT_APP_VERSION = "1.0.0"
V2_DEFAULT_APP_VERSION = "2.0.0"

# Device breakpoint on the larger screen dimension.
TABLET_MIN_PX = 1024

# Catalog complexity: mean of ingredient_count / 20 and coalesce(total_time, 40) / 60.
COMPLEXITY_INGREDIENT_DIV = 20.0
COMPLEXITY_TIME_DEFAULT = 40.0
COMPLEXITY_TIME_DIV = 60.0

# Serving defaults for missing model inputs; anything else defaults to 0.
SERVING_DEFAULTS: dict[str, float] = {
    "total_time": 40.0,
    "servings": 4.0,
    "ingredient_count": 8.0,
    "unique_ingredients": 8.0,
    "complexity_score": 0.5,
    "ingredient_count_db": 8.0,
}
# Serving profile of a user without history.
DEFAULT_SERVING_AVG_RATING = 2.5

# Days used when no interaction is known, and the recency half-scale in days.
NO_HISTORY_DAYS = 999
RECENCY_SCALE_DAYS = 30.0

# The 29 model features (in catalog order).
FEATURES: list[str] = [
    "total_interactions", "avg_rating", "total_rating", "rating_std", "unique_recipes",
    "activity_days", "interactions_per_day", "engagement_score", "total_time", "servings",
    "ingredient_count", "unique_ingredients", "complexity_score", "ingredient_count_db",
    "user_complexity_match", "user_recipe_engagement_match", "user_time_compatibility",
    "user_author_interaction_count", "has_interacted_with_author", "author_affinity_score",
    "user_recipe_interaction_count", "user_recipe_max_rating", "user_recipe_avg_rating",
    "user_recipe_last_interaction", "has_interacted_with_recipe", "recipe_recency_score",
    "ingredient_similarity_score", "ingredient_overlap_count", "has_common_ingredients",
]

# Columns never used as model features.
EXCLUDED_COLUMNS: list[str] = [
    "recipe_name", "recipe_img", "author_name", "author_id", "tags", "recipe_url",
    "description", "instruction", "note", "created_at", "updated_at", "first_interaction",
    "last_interaction", "primary_device", "primary_platform", "prep_time", "cook_time",
    "is_mobile_user", "is_ios_user",
]


# Text encodings: vocabulary sizes and hash dimensions.
TAGS_TOP_K = 50
NAME_HASH_DIM = 128
DESC_MAX_FEATURES = 500
INSTR_HASH_DIM = 512


# The defaults of the two classes below are fixed values too.
@dataclass(frozen=True)
class RankerParams:
    num_leaves: int = 31
    learning_rate: float = 0.03
    feature_fraction: float = 0.7
    bagging_fraction: float = 0.8
    bagging_freq: int = 5
    min_child_samples: int = 50
    lambda_l1: float = 1.0
    lambda_l2: float = 1.0
    max_boost_rounds: int = 500
    early_stopping_rounds: int = 50
    ndcg_eval_at: tuple[int, ...] = (5, 10, 20)


@dataclass(frozen=True)
class PipelineConfig:
    seed: int = 42
    test_size: float = 0.2
    validation_size: float = 0.2
    negative_sampling_ratio: int = 4
    interaction_weights: dict[str, float] = field(default_factory=lambda: dict(INTERACTION_WEIGHTS))
    ranker: RankerParams = field(default_factory=RankerParams)
    # Eligibility rule of the training pairs: "eq1" keeps users with a label == 1 pair,
    # "gt0" keeps users with any positive label.
    eligibility_rule: str = "eq1"

# Second feature module (fixed values).
DEFAULT_COOK_MINUTES = 30
DEFAULT_SERVINGS = 4
QUICK_MAX_MINUTES = 30
SLOW_MIN_MINUTES = 120
FAMILY_MIN_SERVINGS = 6
HEALTHY_TAGS = ["healthy", "light", "low-fat"]
DEFAULT_PRIMARY_TAG = "main"
POPULAR_AUTHOR_MIN_RECIPES = 5
TRENDING_MAX_DAYS = 30
SIMPLE_MAX_COMPLEXITY = 5
HISTORY_ITEMS = 10
TOP_INGREDIENTS = 5
DEFAULT_USER_FEATURES = {
    "total_interactions": 0, "unique_recipes": 0, "avg_rating": 2.5, "max_rating": 2.5,
    "views_count": 0, "cooked_count": 0, "favourited_count": 0, "clicked_count": 0,
    "cooking_rate": 0.0, "favourite_rate": 0.0, "days_active": 1, "interactions_per_day": 0.0,
    "preferred_time": "evening", "avg_recipe_complexity": 5.0, "avg_ingredient_count": 8.0,
    "prefers_simple_recipes": 0, "top_cuisine": "main", "cuisine_diversity": 1,
    "top_author": "Unknown", "author_loyalty": 0.0, "ingredient_diversity": 0,
    "top_ingredient": "unknown",
}
