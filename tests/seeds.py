"""Seed rows of the source databases (golden fixture)."""

import datetime as dt

from medalake import schemas

LOAD = dt.datetime(2025, 3, 27, 10, 0, 0)

# The source systems' seed rows, in their original order.
CATEGORIES = [(1, "Electronics"), (2, "Clothing"), (3, "Home Appliances"), (4, "Books"), (5, "Toys"),
              (6, "Furniture"), (7, "Sports"), (8, "Health & Beauty"), (9, "Automotive"), (10, "Grocery")]
PRODUCTS = [(101, "Laptop", 1, 1000.00), (102, "T-Shirt", 2, 20.00), (103, "Refrigerator", 3, 500.00),
            (104, "Novel", 4, 15.00), (105, "Doll", 5, 25.00), (106, "Sofa", 6, 300.00),
            (107, "Football", 7, 30.00), (108, "Shampoo", 8, 10.00), (109, "Car Tire", 9, 100.00),
            (110, "Rice Bag", 10, 40.00), (111, "Headphones", 1, 150.00), (112, "Jeans", 2, 50.00),
            (113, "Microwave", 3, 200.00), (114, "Comic Book", 4, 12.00), (115, "Toy Car", 5, 35.00),
            (116, "Dining Table", 6, 450.00), (117, "Basketball", 7, 25.00), (118, "Perfume", 8, 60.00),
            (119, "Engine Oil", 9, 45.00), (120, "Coffee Beans", 10, 20.00)]
CUSTOMERS = [(1, "John Doe", "john@example.com"), (2, "Jane Smith", "jane@example.com"),
             (3, "Michael Johnson", "michael@example.com"), (4, "Emily Davis", "emily@example.com"),
             (5, "David Wilson", "david@example.com"), (6, "Sarah Miller", "sarah@example.com"),
             (7, "Daniel Anderson", "daniel@example.com"), (8, "Olivia Thomas", "olivia@example.com"),
             (9, "James Martinez", "james@example.com"), (10, "Emma Hernandez", "emma@example.com")]
ORDERS = [(1001, 1, 1020.00), (1002, 2, 20.00), (1003, 3, 150.00), (1004, 4, 35.00), (1005, 5, 60.00),
          (1006, 6, 450.00), (1007, 7, 200.00), (1008, 8, 75.00), (1009, 9, 120.00), (1010, 10, 90.00)]
ORDER_ITEMS = [(1, 1001, 101, 1, 1000.00), (2, 1001, 102, 1, 20.00), (3, 1002, 102, 1, 20.00),
               (4, 1003, 111, 1, 150.00), (5, 1004, 115, 1, 35.00), (6, 1005, 118, 1, 60.00),
               (7, 1006, 116, 1, 450.00), (8, 1007, 113, 1, 200.00), (9, 1008, 120, 1, 75.00),
               (10, 1009, 119, 1, 120.00)]


def frames(spark, load=LOAD):
    """Seeds as source relations; defaulted timestamps take the load time."""
    S = schemas.SOURCE
    return {
        "categories": spark.createDataFrame([(i, n, load) for i, n in CATEGORIES], S["categories"]),
        "products": spark.createDataFrame([(i, n, c, p, load) for i, n, c, p in PRODUCTS], S["products"]),
        "customers": spark.createDataFrame([(i, n, e, load) for i, n, e in CUSTOMERS], S["customers"]),
        "orders": spark.createDataFrame([(i, c, load, a, load) for i, c, a in ORDERS], S["orders"]),
        "order_items": spark.createDataFrame([(i, o, p, q, pr, load) for i, o, p, q, pr in ORDER_ITEMS],
                                             S["order_items"]),
    }
