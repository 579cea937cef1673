"""Hand-written raw rental tables with the edge rows the build must handle.

All rows are invented. Calendar window: 2021-07-12 .. 2021-07-21 (10 nights).
"""

import datetime as dt

from stayflow.plans.build import BuildConfig

D = dt.date
START = D(2021, 7, 12)
DAYS = [START + dt.timedelta(days=i) for i in range(10)]

LISTINGS_SCHEMA = ("id long, name string, host_id long, host_name string, host_since date, host_location string, "
                   "host_verifications string, neighborhood string, property_type string, room_type string, "
                   "accommodates int, bathrooms_text string, bedrooms int, beds int, amenities string, price string, "
                   "number_of_reviews int, first_review string, last_review string, review_scores_rating double")
LISTINGS = [
    (1, "Loft", 100, "Maria", D(2015, 1, 1), "Austin", '["email","phone"]', "Downtown", "Apartment",
     "Entire home/apt", 4, "2.5 baths", 2, 2, "[]", "$1,234.00", 10, "2019-01-01", "2021-06-01", 4.9),
    # same host, attributes disagree (earlier host_since, longer verification list)
    (2, "Room", 100, "Maria", D(2014, 5, 5), "Austin", '["email","phone","government_id"]', "Downtown", "House",
     "Private room", 2, "1 Shared bath", None, 0, "[]", "$85.00", 0, "", "", None),
    # NULL host name, malformed verifications, Half-bath, non-numeric price
    (3, "Cabin", 200, None, D(2018, 1, 1), "Dallas", "not json", "Hills", "Cabin", "Entire home/apt", 6,
     "Half-bath", 3, 4, "[]", "abc", 5, "2020-02-02", "2021-07-01", 4.2),
    # NULL id: rejected at staging
    (None, "Ghost", 300, "Sam", D(2019, 1, 1), "Waco", "[]", "Hills", "Cabin", "Private room", 1, "1 bath", 1, 1,
     "[]", "$10.00", 0, "", "", None),
]
# listing 4 has calendar and change-log rows but no listings row: deleted

CALENDAR_SCHEMA = ("listing_id long, date date, available boolean, reservation_id string, price string, "
                   "minimum_nights int, maximum_nights int")


def _calendar():
    rows = []
    l1 = [True, True, False, False, True, True, True, True, True, False]
    r1 = {2: "R1", 3: "R1", 9: "R2"}
    for i, d in enumerate(DAYS):
        rows.append((1, d, l1[i], r1.get(i, "NULL"), "100.00", 1, 3))
    rows += [rows[0], rows[0]]                                 # first row present three times
    for d in DAYS:                                             # never open; same id as listing 1 (R1)
        rows.append((2, d, False, "R1", "50.00", 2, 30))
    for i, d in enumerate(DAYS):                               # open all window, strict minimum
        rows.append((3, d, True, "NULL", "90.00" if i < 5 else "95.00", 12 if i == 4 else 2, 20))
    for i, d in enumerate(DAYS):                               # deleted listing, stay touching the first day
        rows.append((4, d, i >= 3, "R7" if i < 3 else "NULL", "70.00", 1, 5))
    return rows


CALENDAR = _calendar()

CHANGELOG_SCHEMA = "listing_id long, change_at timestamp, amenities string"
T = dt.datetime
CHANGELOG = [
    (1, T(2020, 1, 1), '["Wifi","Lockbox"]'),
    (1, T(2021, 1, 1), '["Wifi","Lockbox","First aid kit"]'),   # latest wins
    (2, T(2021, 1, 1), '["Kitchen"]'),
    (2, T(2021, 1, 1), '["Heating"]'),                           # equal timestamps
    (3, T(2021, 2, 1), '["Sauna","Kitchen"]'),                   # a value outside the vocabulary
    (4, T(2021, 3, 1), '["Wifi"]'),
    (5, T(2021, 3, 1), "oops"),                                  # malformed: listing kept, no amenities
]

CONFIG = BuildConfig(
    expected_deleted_listings=2,
    pii_salt="test-salt",
    amenities=("First aid kit", "Heating", "Kitchen", "Lockbox", "Wifi"),
    verifications=("email", "government_id", "phone"),
    fact_flags=("has_wifi", "has_lockbox", "has_first_aid_kit"),
    listing_flags=("has_wifi", "has_lockbox", "has_first_aid_kit", "has_kitchen", "has_heating"),
    roles={"primary": "has_wifi", "first": "has_lockbox", "second": "has_first_aid_kit"},
)


def raw_frames(spark):
    return {
        "listings": spark.createDataFrame(LISTINGS, LISTINGS_SCHEMA),
        "calendar": spark.createDataFrame(CALENDAR, CALENDAR_SCHEMA),
        "amenities_changelog": spark.createDataFrame(CHANGELOG, CHANGELOG_SCHEMA),
    }
