"""Configuration as data: column mapping, table layouts, fill defaults.

Nothing here runs Spark. Every list below is a fixed value that has to
agree with the listing files the pipeline is built for (their headers,
the identifier codes, the defaults written for missing values).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Raw header -> target column -> target type.
# Every raw value is read as a string; the target type is applied by
# ``operators.schema.apply_mapping``.  "double" stands for the source's
# float columns (single precision would print 0.1 as 0.10000000149...).
# ---------------------------------------------------------------------------
COLUMN_MAPPING: list[tuple[str, str, str]] = [
    ("Listing Title", "listingTitle", "string"),
    ("Property Type", "propertyType", "string"),
    ("Listing Type", "listingType", "string"),
    ("Created Date", "createdDate", "date"),
    ("Country", "country", "string"),
    ("State", "state", "string"),
    ("City", "city", "string"),
    ("Zipcode", "zipcode", "string"),
    ("Currency Native", "currencyNative", "string"),
    ("Number of Reviews", "numberOfReviews", "int"),
    ("Bedrooms", "bedrooms", "int"),
    ("Bathrooms", "bathrooms", "int"),
    ("Max Guests", "maxGuests", "int"),
    ("Airbnb Superhost", "superhost", "string"),
    ("Cancellation Policy", "cancellationPolicy", "string"),
    ("Cleaning Fee (USD)", "cleaningFeeUSD", "double"),
    ("Cleaning Fee (Native)", "cleaningFeeNative", "double"),
    ("Extra People Fee(Native)", "extraPeopleFeeNative", "double"),
    ("Extra People Fee (USD)", "extraPeopleFeeUSD", "double"),
    ("Check-in Time", "checkinTime", "string"),
    ("Checkout Time", "checkoutTime", "string"),
    ("Minimum Stay", "minimumStay", "int"),
    ("Latitude", "latitude", "double"),
    ("Longitude", "longitude", "double"),
    ("Exact Location", "exactLocation", "string"),
    ("Overall Rating", "overallRating", "double"),
    ("Airbnb Accuracy Rating", "accuracyRating", "int"),
    ("Airbnb Communication Rating", "communicationRating", "int"),
    ("Airbnb Value Rating", "valueRating", "int"),
    ("Airbnb Checkin Rating", "checkinRating", "int"),
    ("Airbnb Cleanliness Rating", "cleanlinessRating", "int"),
    ("Airbnb Location Rating", "locationRating", "int"),
    ("Amenities", "amenities", "string"),
    ("picture_url", "pictureURL", "string"),
    ("License", "license", "string"),
    ("Airbnb Property ID", "propertyId", "string"),
    ("Airbnb Host ID", "hostId", "string"),
    ("Host Listing Count", "hostListingCount", "int"),
    ("guest_controls", "guestControls", "string"),
    ("instant_bookable", "instantBookable", "string"),
    ("Pets Allowed", "petsAllowed", "string"),
    ("Listing URL", "listingURL", "string"),
    ("Instantbook Enabled", "instantBookEnabled", "string"),
    ("Count Available Days LTM", "countAvailableDaysLtm", "int"),
    ("Count Blocked Days LTM", "countBlockedDaysLtm", "int"),
    ("Count Reservation Days LTM", "countReservationDaysLtm", "int"),
    ("Occupancy Rate LTM", "occupancyRateLtm", "int"),
    ("Number of Bookings LTM", "numberOfBookingsLtm", "int"),
    ("Number of Bookings LTM - Number of observed month", "numberOfBookingsLtmObservedMonth", "int"),
    ("Average Daily Rate (Native)", "averageDailyRateNative", "double"),
    ("Average Daily Rate (USD)", "averageDailyRateUSD", "double"),
    ("Annual Revenue LTM (USD)", "annualRevenueLtmUSD", "double"),
    ("Annual Revenue LTM (Native)", "annualRevenueLtmNative", "double"),
]

TARGET_TYPES: dict[str, str] = {target: typ for _, target, typ in COLUMN_MAPPING}
TARGET_COLUMNS: list[str] = [target for _, target, _ in COLUMN_MAPPING]

# Date text format of "Created Date".
DATE_FORMAT = "yyyy-MM-dd"

# Lineage column added when sources are united (one value per input file set).
SOURCE_COL = "src"

# ---------------------------------------------------------------------------
# Generated identifiers, name -> three-letter code.
# An id is <source prefix><code><sequence>, e.g. LOSLIS1.
# ---------------------------------------------------------------------------
ID_CODES: dict[str, str] = {
    "listingId": "LIS",
    "amenitiesId": "AMT",
    "reviewId": "REV",
    "checkInOutId": "CHK",
    "locationId": "LOC",
    "pricingId": "PRC",
    "bookingId": "BOK",
}

# Natural key that orders the deterministic sequence within a source.
NATURAL_KEY = "propertyId"

# Columns that must all be null for a row to be dropped as empty.
COMMON_MISSING = ["propertyType", "listingType", "bedrooms"]

# ---------------------------------------------------------------------------
# Columns of the seven dimensions and the fact.
# ---------------------------------------------------------------------------
TABLE_COLUMNS: dict[str, list[str]] = {
    "listing": ["listingId", "propertyId", "bedrooms", "bathrooms", "maxGuests", "listingTitle",
                "propertyType", "listingType", "listingURL", "pictureURL", "createdDate",
                "cancellationPolicy", "instantBookable", "petsAllowed"],
    "host": ["hostId", "hostListingCount", "superhost"],
    "location": ["locationId", "country", "state", "city", "zipcode", "longitude", "latitude",
                 "exactLocation"],
    "amenities": ["amenitiesId", "amenities"],
    "review": ["reviewId", "numberOfReviews", "locationRating", "communicationRating",
               "overallRating", "accuracyRating", "valueRating", "checkinRating",
               "cleanlinessRating"],
    "checkin": ["checkInOutId", "checkinTime", "checkoutTime", "minimumStay"],
    "pricing": ["pricingId", "currencyNative", "cleaningFeeUSD", "cleaningFeeNative",
                "extraPeopleFeeUSD", "extraPeopleFeeNative", "averageDailyRateUSD",
                "averageDailyRateNative"],
    "booking": ["bookingId", "hostId", "listingId", "amenitiesId", "propertyId", "reviewId",
                "checkInOutId", "locationId", "pricingId", "occupancyRateLtm",
                "numberOfBookingsLtm", "numberOfBookingsLtmObservedMonth", "countBlockedDaysLtm",
                "instantBookEnabled", "countReservationDaysLtm", "countAvailableDaysLtm",
                "annualRevenueLtmUSD", "annualRevenueLtmNative"],
}

# Text flags ("t"/"f") converted to booleans, per table.
FLAG_COLUMNS: dict[str, list[str]] = {
    "listing": ["instantBookable", "petsAllowed"],
    "location": ["exactLocation"],
    "host": ["superhost"],
    "booking": ["instantBookEnabled"],
}

# ---------------------------------------------------------------------------
# Defaults written for missing values, per table.  A value is
# cast to the column's type (0 on a text column becomes "0").  Flags are
# filled after their conversion to boolean.  The check-in time columns are
# filled with their most frequent value instead (operators.impute.mode_impute).
# countBlockedDaysLtm has no default.
# ---------------------------------------------------------------------------
FILL_DEFAULTS: dict[str, dict[str, object]] = {
    "listing": {
        "propertyId": 0,
        "listingTitle": "Unknown",
        "propertyType": "Not Specified",
        "listingType": "Not Specified",
        "listingURL": "No URL",
        "pictureURL": "No Image",
        "createdDate": "1970-01-01",
        "bedrooms": 1,
        "bathrooms": 1,
        "maxGuests": 2,
        "instantBookable": False,
        "petsAllowed": False,
        "cancellationPolicy": "Not Specified",
    },
    "location": {
        "country": "Unknown",
        "state": "Unknown",
        "city": "Unknown",
        "zipcode": "000000",
        "latitude": 0.0,
        "longitude": 0.0,
        "exactLocation": False,
    },
    "host": {
        "hostId": 0,
        "hostListingCount": 0,
        "superhost": False,
    },
    "review": {
        "numberOfReviews": 0,
        "overallRating": 0.0,
        "communicationRating": 0.0,
        "accuracyRating": 0.0,
        "cleanlinessRating": 0.0,
        "checkinRating": 0.0,
        "locationRating": 0.0,
        "valueRating": 0.0,
    },
    "checkin": {
        "minimumStay": 1,
    },
    "pricing": {
        "currencyNative": "0.0",
        "cleaningFeeUSD": 0.0,
        "cleaningFeeNative": 0.0,
        "extraPeopleFeeUSD": 0.0,
        "extraPeopleFeeNative": 0.0,
        "averageDailyRateUSD": 0.0,
        "averageDailyRateNative": 0.0,
    },
    "booking": {
        "occupancyRateLtm": 0.0,
        "numberOfBookingsLtm": 0,
        "numberOfBookingsLtmObservedMonth": 0,
        "instantBookEnabled": False,
        "countReservationDaysLtm": 0,
        "countAvailableDaysLtm": 0,
        "annualRevenueLtmUSD": 0.0,
        "annualRevenueLtmNative": 0.0,
    },
}

# Check-in text columns whose missing values take the column's mode.
MODE_COLUMNS = ["checkoutTime", "checkinStartTime", "checkinEndTime"]

# Text used when check-in is "Flexible" (both ends of the window).
FLEXIBLE_TIME = "12:00 AM"

# ---------------------------------------------------------------------------
# Code point ranges replaced by one space each (emoji,
# pictographs, dingbats, arrows, geometric shapes).
# ---------------------------------------------------------------------------
SYMBOL_RANGES: list[tuple[int, int]] = [
    (0x1F600, 0x1F64F),  # emoticons
    (0x1F300, 0x1F5FF),  # symbols and pictographs
    (0x1F680, 0x1F6FF),  # transport and map symbols
    (0x1F1E0, 0x1F1FF),  # flags
    (0x02700, 0x027BF),  # dingbats
    (0x02600, 0x026FF),  # miscellaneous symbols
    (0x02B00, 0x02BFF),  # miscellaneous symbols and arrows
    (0x1F100, 0x1F1FF),  # enclosed alphanumeric supplement
    (0x1F200, 0x1F2FF),  # enclosed ideographic supplement
    (0x1F900, 0x1F9FF),  # supplemental symbols and pictographs
    (0x025A0, 0x025FF),  # geometric shapes
]

# Fixed value: a column is "plain text" when every non-null value matches this.
PLAIN_TEXT_PATTERN = r"""^[a-zA-Z0-9\s\.,!?'"-]+$"""

# Scripts that tell a language by themselves: Unicode script -> language.  Letters of the
# Japanese syllabaries decide over Han characters, which both languages use.
SCRIPT_LANGUAGES: dict[str, str] = {
    "Arabic": "ar", "Cyrillic": "ru", "Devanagari": "hi", "Greek": "el", "Han": "zh", "Hangul": "ko",
    "Hebrew": "he", "Hiragana": "ja", "Katakana": "ja", "Thai": "th",
}

# Target language of translation.
TARGET_LANGUAGE = "en"

# Earth radius used by the haversine distance.
EARTH_RADIUS_KM = 6371.0
