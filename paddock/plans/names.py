"""Column names of the feature tables.

Fixed values: trained models, stored statistics and the encoding dictionary
refer to these names, so they are kept as they are.  Long families follow from
a rule.
"""

from __future__ import annotations

KEYS = ("user_id", "clue_id", "recommend_id", "label", "ts")

# Sparse item features: (attribute, feature name, dictionary name).
ITEM_SPARSE = (
    ("evaluate_score_segment", "s_i_c2b_evaluate_score_segment", "c2b_evaluate_score_segment"),
    ("city_id", "s_i_city_id", "city_id"),
    ("emission_standard", "s_i_emission_standard", "emission_standard"),
    ("minor_category_id", "s_i_minor_category_id", "minor_category_id"),
    ("model_price_bin", "s_i_model_price_bin", "model_price_bin"),
    ("car_year", "s_i_car_year", "car_year"),
    ("gearbox", "s_i_gearbox", "gearbox"),
    ("air_displacement", "s_i_air_displacement", "air_displacement"),
    ("tag_id", "s_i_tag_id", "tag_id"),
    ("car_color", "s_i_car_color", "car_color"),
    ("guobie", "s_i_guobie", "guobie"),
    ("evaluate_level", "s_i_c2b_evaluate_level", "c2b_evaluate_level"),
    ("auto_type", "s_i_auto_type", "auto_type"),
    ("fuel_type", "s_i_fuel_type", "fuel_type"),
    ("seats", "s_i_seats", "seats"),
    ("car_level", "s_i_c2b_ctob_car_level", "c2b_ctob_car_level"),
)

# Item rates of the day before: source column -> feature name.
ITEM_RATES = {
    "click_bid_rate_0_3": "d_i_c2b_offline_car_click_bid_rate_0_3_d",
    "click_bid_rate_0_30": "d_i_c2b_offline_car_click_bid_rate_0_30_d",
    "beseen_click_rate_0_3": "d_i_c2b_offline_car_beseen_click_rate_0_3_d",
    "beseen_click_rate_0_30": "d_i_c2b_offline_car_beseen_click_rate_0_30_d",
    "tag_id_bid_percent_ratio_0_7": "d_i_c2b_offline_car_tag_id_bid_percent_ratio_0_7_d",
    "tag_id_bid_percent_ratio_7_14": "d_i_c2b_offline_car_tag_id_bid_percent_ratio_7_14_d",
    "tag_id_bid_percent_ratio_14_30": "d_i_c2b_offline_car_tag_id_bid_percent_ratio_14_30_d",
    "tag_id_click_rate_0_7": "d_i_c2b_offline_car_tag_id_click_rate_0_7_d",
    "tag_id_click_rate_7_14": "d_i_c2b_offline_car_tag_id_click_rate_7_14_d",
    "tag_id_bid_rate_0_7": "d_i_c2b_offline_car_tag_id_bid_rate_0_7_d",
    "tag_id_bid_rate_7_14": "d_i_c2b_offline_car_tag_id_bid_rate_7_14_d",
    "minor_category_id_click_rate_0_7": "d_i_c2b_offline_car_minor_category_id_click_rate_0_7_d",
}

ITEM_DENSE = {
    "transfer_num": "d_i_transfer_num",
    "evaluate_score": "d_i_c2b_evaluate_score",
    "model_price": "d_i_c2b_ctob_model_price",
    "seller_price": "d_i_c2b_seller_price",
    "diff_price": "d_i_c2b_ctob_diff_price",
    "road_haul": "d_i_road_haul",
}

# Favourite categories of a user; orders lack the last three.
CLUSTERS = (
    "tag_id", "seats", "minor_category_id", "guobie", "gearbox", "fuel_type",
    "emission_standard", "city_id", "car_year", "auto_type", "car_color",
    "evaluate_level_segment", "evaluate_score_segment", "model_price_bin",
)
ORDER_CLUSTERS = CLUSTERS[:11]
# Clusters whose feature and dictionary names carry a further prefix.
PREFIXED_CLUSTERS = ("evaluate_level_segment", "evaluate_score_segment")

MEASURES = ("road_haul", "evaluate_score")
STATS = {"max": "max", "min": "min", "median": "p50"}
# The vector refresh counts collections too, and has prices among its measures.
REFRESH_COUNTS = {"beseen": "beseen", "click": "click", "bid": "bid", "collect": "quick_collection"}
REFRESH_MEASURES = ("suggest_price", "road_haul", "evaluate_score")

# Attributes of a behaviour sequence: attribute -> name inside the feature.
SEQ_SPARSE = {
    "clue_id": "clue_id", "fuel_type": "fuel_type", "car_year": "car_year",
    "gearbox": "gearbox", "emission_standard": "emission_standard", "tag_id": "tag_id",
    "city_id": "city_id", "car_color": "car_color", "guobie": "guobie",
    "minor_category_id": "minor_category_id", "auto_type": "auto_type", "seats": "seats",
    "evaluate_level": "evaluate_level",
    "evaluate_score_segment": "c2b_evaluate_score_segment",
    "car_level": "c2b_ctob_car_level", "model_price_bin": "model_price_bin",
}
SEQ_DENSE = {
    "seller_price": "c2b_seller_price", "road_haul": "road_haul",
    "evaluate_score": "c2b_evaluate_score", "transfer_num": "transfer_num",
    "model_price": "c2b_ctob_model_price", "diff_price": "c2b_ctob_diff_price",
}
SEQ_ACTIONS = ("click", "bid", "contract")
# Dictionary names of the sequence items where they differ from the attribute.
SEQ_DICTIONARY = {
    "evaluate_level_segment": "c2b_evaluate_level_segment",
    "evaluate_score_segment": "c2b_evaluate_score_segment",
}
# Statistics over the last clicked items: measure -> feature name.
REALTIME = {
    "road_haul": "d_u_c2b_realtime_user_road_haul_{stat}_fix",
    "evaluate_score": "d_u_c2b_realtime_user_evaluate_score_{stat}",
    "seller_price": "d_u_c2b_realtime_user_seller_price_{stat}",
    "model_price": "d_u_c2b_realtime_user_model_price_{stat}",
    "diff_price": "d_u_c2b_realtime_user_diff_price_{stat}",
}

SEQ_LENGTH = 10
VISIBLE_AFTER = 60  # seconds until an event can be seen
HISTORY_DAYS, ORDER_DAYS, PRICE_DAYS = 29, 90, 90
DICTIONARY_VERSION = "2024-11-01"


def action_count_columns() -> dict:
    """Output -> (action, source)."""
    return {
        f"d_u_{a}_cnt_{w}": (a, f"cnt_{w}")
        for a in ("beseen", "click", "bid") for w in ("0_7", "7_14", "14_30")
    }


def _stat_columns(name, action, days, window) -> dict:
    return {
        f"d_u_{name}_{m}_{s}_{window}": (action, days, f"{m}_{src}")
        for m in MEASURES for s, src in STATS.items()
    }


def action_stat_columns() -> dict:
    """Output -> (action, window days, source)."""
    out = {}
    for days, window in ((7, "0_7"), (30, "0_30")):
        for a in ("click", "bid"):
            out.update(_stat_columns(a, a, days, window))
    return out


def order_stat_columns() -> dict:
    out = {}
    for days, window in ((30, "0_30"), (365, "0_365")):
        out.update(_stat_columns("deal", "beseen", days, window))
    return out


def refresh_count_columns() -> dict:
    """Output -> (action, source)."""
    return {
        f"d_u_{n}_cnt_{w}": (a, f"cnt_{w}")
        for n, a in REFRESH_COUNTS.items() for w in ("0_7", "7_14", "14_30")
    }


def refresh_stat_columns() -> dict:
    """Output -> (action, source); over all windows."""
    return {
        f"d_u_{a}_{m}_{s}_0_30": (a, f"{m}_{src}")
        for a in ("click", "bid") for m in REFRESH_MEASURES for s, src in STATS.items()
    }


def refresh_dense() -> list:
    return [*refresh_count_columns(), "d_u_contract_cnt_30", "d_u_contract_cnt_365", *refresh_stat_columns()]


def refresh_sparse() -> dict:
    """Favourite category -> the attribute whose embedding it shares."""
    every = {**action_favourites(), **order_favourites("0_30"), **order_favourites("0_365")}
    return {feature: spec[-1] for feature, spec in every.items()}


def cluster_name(cluster: str) -> str:
    return f"c2b_{cluster}" if cluster in PREFIXED_CLUSTERS else cluster


def action_favourites() -> dict:
    """Output -> (action, cluster)."""
    return {
        f"s_u_{a}_{cluster_name(c)}_0_7": (a, c) for a in ("click", "bid") for c in CLUSTERS
    }


def order_favourites(window: str) -> dict:
    """Output -> (cluster,)."""
    return {f"s_u_deal_{c}_{window}": (c,) for c in ORDER_CLUSTERS}


def seq_name(kind: str, action: str, name: str) -> str:
    return f"{kind}_seq_c2b_{action}_{name}_seq"
