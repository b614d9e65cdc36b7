"""Rating and review analytics written as Spark plans."""

USER = "user_id"
ITEM = "business_id"
RATING = "rating"
PREDICTION = "prediction"
PAIR = [USER, ITEM]
