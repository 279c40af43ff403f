"""Sample inputs with known results."""

import json

PV_EVENTS = [
    json.dumps({"userID": "user_5", "eventTime": f"2019-08-18 09:17:{s}", "eventType": kind, "productID": 3})
    for s, kind in [(20, "click"), (21, "browse"), (22, "browse"), (29, "click"), (39, "browse"), (49, "browse")]
]
PV_LINES = ["2019-08-18 09:17:20,2019-08-18 09:17:40,browse,3", "2019-08-18 09:17:20,2019-08-18 09:17:40,click,2"]

USER_EVENTS = [
    json.dumps({"userID": u, "eventTime": f"2019-08-18 {t}", "eventType": k, "productID": p})
    for u, t, k, p in [
        ("user_5", "08:17:19", "browse", 3), ("user_3", "08:17:19", "click", 1), ("user_2", "08:17:20", "click", 3),
        ("user_5", "08:17:20", "browse", 1), ("user_2", "08:19:52", "browse", 8)]
]
USER_COUNTS = ["user_5 : 1", "user_3 : 1", "user_2 : 1", "user_5 : 2", "user_2 : 2"]


def browse(second):
    return json.dumps({"userID": "user_2", "eventTime": f"2019-11-16 17:30:{second:02d}", "eventType": "browse",
                       "productID": "product_1", "productPrice": 10})


def click(second):
    return json.dumps({"userID": "user_2", "eventTime": f"2019-11-16 17:30:{second:02d}", "eventType": "click",
                       "pageID": "page_1"})


BROWSE_SECONDS, CLICK_SECONDS = (1, 2, 5, 10), (1, 2, 3, 10)
JOINED = {
    "inner": [(1, 1), (2, 2), (10, 10)],
    "left": [(1, 1), (2, 2), (5, None), (10, 10)],
    "right": [(1, 1), (2, 2), (10, 10), (None, 3)],
}

PAIRS = [(2, 3), (2, 1), (2, 5), (2, 5), (2, 10), (2, 20)]
PAIR_MEANS = [(2, 2), (2, 5), (2, 15)]
PAIR_MEANS_PADDED = [(0, 0), (2, 2), (0, 0), (2, 5), (0, 0), (2, 15)]

BEHAVIOR = [
    (1, "buy", "iphone"), (1, "cart", "huawei"), (1, "buy", "logi"), (1, "fav", "oppo"), (2, "buy", "huawei"),
    (2, "buy", "onemore"), (2, "fav", "iphone"), (2, "fav", "iphone"), (2, "fav", "iphone")]
BEHAVIOR_COUNTS = [
    (1, "buy", 1), (1, "cart", 1), (1, "buy", 2), (1, "fav", 1), (2, "buy", 1), (2, "buy", 2), (2, "fav", 1),
    (2, "fav", 2), (2, "fav", 3)]

ACTIONS = [
    ("productID1", "click", "user_1"), ("productID1", "click", "user_2"), ("productID1", "browse", "user_1"),
    ("productID2", "browse", "user_1"), ("productID2", "click", "user_2"), ("productID2", "click", "user_1")]

HOST_LINE = "Linux|amd64|6.1|4|12.5%|7.63GB|40.1%|17|Debian|1614562657466|2021-3-1 10:37:37"
