"""The static catalogue and the shape of the made tables.

These must equal the published catalogue for results to match, so they are
stated plainly here and nowhere else.
"""

# category_id, category_name
CATEGORIES = [
    (1, "Electronics"),
    (2, "Clothing"),
    (3, "Home Appliances"),
    (4, "Books"),
    (5, "Sports"),
    (6, "Beauty and Personal Care"),
    (7, "Groceries"),
]

PRODUCT_NAMES = {
    "Electronics": ["Smartphone", "Laptop", "Charger", "Headphones", "Tablet", "Smartwatch", "Camera"],
    "Clothing": ["T-Shirt", "Jeans", "Jacket", "Dress", "Shorts", "Sweater", "Cap"],
    "Home Appliances": ["Refrigerator", "Washing Machine", "Microwave", "Air Conditioner", "Blender", "Mixer", "Vacuum Cleaner"],
    "Books": ["Novel", "Comics", "Cookbook", "Biography", "Science Book", "Travel Guide", "Children Book"],
    "Sports": ["Football", "Cricket Bat", "Tennis Racket", "Basketball", "Yoga Mat", "Dumbbells", "Helmet"],
    "Beauty and Personal Care": ["Shampoo", "Conditioner", "Facewash", "Lipstick", "Perfume", "Lotion", "Soap"],
    "Groceries": ["Rice", "Wheat", "Sugar", "Oil", "Salt", "Milk", "Tea"],
}

PRODUCT_PRICES = {
    "Electronics": [65000, 30000, 2000, 8000, 3500, 20000, 18000],
    "Clothing": [700, 1800, 3500, 2200, 1500, 900, 1300],
    "Home Appliances": [28000, 24000, 12000, 42000, 7000, 6000, 1500],
    "Books": [450, 600, 550, 900, 500, 650, 350],
    "Sports": [2200, 900, 1800, 700, 3000, 3500, 1500],
    "Beauty and Personal Care": [350, 450, 2200, 1800, 1600, 700, 400],
    "Groceries": [450, 180, 60, 320, 250, 40, 30],
}

# A repeated percentage is a likelier one.
DISCOUNT_PERCENTS = {
    "Electronics": [0, 0, 0, 5, 5, 10],
    "Clothing": [0, 0, 10, 10, 20, 30],
    "Home Appliances": [0, 0, 0, 5, 10, 15],
    "Books": [0, 0, 0, 5, 5, 10],
    "Sports": [0, 0, 5, 10, 15, 20],
    "Beauty and Personal Care": [0, 0, 5, 10, 10, 20],
    "Groceries": [0, 0, 0, 0, 5, 5],
}

PAYMENT_METHODS = ["UPI", "Cash", "Card"]

# value, weight
STATUS_WEIGHTS = [("completed", 70), ("pending", 15), ("cancelled", 10), ("returned", 5)]
BASKET_SIZE_WEIGHTS = [(1, 25), (2, 35), (3, 25), (4, 10), (5, 5)]
QUANTITY_WEIGHTS = [(1, 50), (2, 25), (3, 15), (4, 7), (5, 3)]

# Positions 0 and 1 of each category, when the popularity option is on.
POPULAR_POSITIONS = 2
POPULAR_WEIGHT = 5

DEFECT_RATE_PERCENT = 3
DEFECT_KINDS = ["invalid_fk", "negative_qty", "future_date"]
INVALID_PRODUCT_ID = 9999
INVALID_PRODUCT_NAME = "INVALID_PRODUCT"
FUTURE_DAYS = 10

DEFAULT_TARGET_ITEMS = 100_000
MIN_CUSTOMERS = 200
ITEMS_PER_CUSTOMER = 7
MIN_ORDERS = 300
ITEMS_PER_ORDER = 2

SIGNUP_WINDOW_DAYS = 90
OPENING_HOUR = 8
CLOSING_HOUR = 22

COMPLETED = "completed"
CLEAN_TABLE_PREFIX = "processed_"
