"""A small shop's raw CSV files, with every defect the rules look for.

Orders, by number:
  1  ana, delivered the day before it was promised; two payments, three items
  2  ana again, at the very moment of order 1; delivered on the promised day, at 9 pm
  3  ana, exactly 90 days after her first orders; delivered one day late
  4  bia, delivered with a handover but no delivery date: to be estimated
  5  bia, one second past 90 days after her first; delivered eight days late
  6  caio, delivered with neither date: to be dropped with all it has
  7  davi, shipped and not arrived
  8  eva, canceled, but paid
  9  eva, unavailable: no items, paid
 10  fabio, delivered eight days early; no payment
 11  gil, delivered seven days late; no review
"""

from __future__ import annotations

FILES = {}

FILES["customers"] = """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,ana,01001,são paulo,SP
c2,ana,01001,são paulo,SP
c3,ana,01002,campinas,SP
c4,bia,20000,rio de janeiro,RJ
c5,bia,20000,rio de janeiro,RJ
c6,caio,30000,belo horizonte,MG
c7,davi,30000,belo horizonte,MG
c8,eva,99999,nowhere,RS
c9,eva,99999,nowhere,RS
c10,fabio,01001,são paulo,SP
c11,gil,01001,são paulo,SP
"""

# Two exact copies, and one zip at two different points.
FILES["geolocation"] = """geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state
01001,-23.5,-46.5,são paulo,SP
01001,-23.5,-46.5,são paulo,SP
01001,-23.7,-46.7,são paulo,SP
01002,-22.9,-47.0,campinas,SP
20000,-22.912345678901234,-43.2,rio de janeiro,RJ
30000,-19.9,-43.9,belo horizonte,MG
30000,-19.9,-43.9,belo horizonte,MG
"""

FILES["orders"] = """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,\
order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2018-01-01 10:00:00,2018-01-01 11:00:00,2018-01-02 08:00:00,2018-01-19 12:00:00,2018-01-20 00:00:00
o2,c2,delivered,2018-01-01 10:00:00,2018-01-01 10:00:00,2018-01-02 08:00:00,2018-01-20 21:00:00,2018-01-20 00:00:00
o3,c3,delivered,2018-04-01 10:00:00,2018-04-01 10:30:00,2018-04-02 08:00:00,2018-04-21 00:30:00,2018-04-20 00:00:00
o4,c4,delivered,2018-02-01 09:00:00,2018-02-01 09:30:00,2018-02-03 00:00:00,,2018-02-20 00:00:00
o5,c5,delivered,2018-05-02 09:00:01,2018-05-02 09:30:00,2018-05-03 00:00:00,2018-05-28 10:00:00,2018-05-20 00:00:00
o6,c6,delivered,2018-03-01 09:00:00,2018-03-01 09:30:00,,,2018-03-20 00:00:00
o7,c7,shipped,2018-03-02 09:00:00,2018-03-02 09:30:00,2018-03-05 00:00:00,,2018-03-20 00:00:00
o8,c8,canceled,2018-03-03 09:00:00,,,,2018-03-20 00:00:00
o9,c9,unavailable,2018-03-04 09:00:00,2018-03-04 09:30:00,,,2018-03-20 00:00:00
o10,c10,delivered,2018-03-05 09:00:00,2018-03-05 09:30:00,2018-03-06 00:00:00,2018-03-12 10:00:00,2018-03-20 00:00:00
o11,c11,delivered,2018-03-06 09:00:00,2018-03-06 09:30:00,2018-03-07 00:00:00,2018-03-27 10:00:00,2018-03-20 00:00:00
"""

# p6 is sold on order 6 alone, so cleaning leaves it without an order.
FILES["order_items"] = """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2018-01-05 10:00:00,10.00,1.00
o1,2,p1,s1,2018-01-05 10:00:00,10.00,1.00
o1,3,p2,s2,2018-01-05 10:00:00,30.50,0.00
o2,1,p2,s2,2018-01-05 10:00:00,30.50,2.00
o3,1,p3,s3,2018-04-05 10:00:00,5.25,2.00
o3,2,p4,s1,2018-04-05 10:00:00,7.75,2.00
o4,1,p1,s1,2018-02-05 10:00:00,10.00,1.00
o5,1,p5,s3,2018-05-05 10:00:00,99.99,9.99
o6,1,p6,s1,2018-03-05 10:00:00,44.00,4.00
o7,1,p2,s2,2018-03-05 10:00:00,30.50,2.00
o8,1,p1,s1,2018-03-05 10:00:00,1000.00,1.00
o10,1,p7,s3,2018-03-05 10:00:00,50.00,5.00
o11,1,p3,s3,2018-03-05 10:00:00,5.25,2.00
"""

FILES["order_payments"] = """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,voucher,1,20.00
o1,2,credit_card,3,32.50
o2,1,credit_card,1,32.50
o3,1,boleto,1,17.00
o4,1,boleto,1,11.00
o5,1,credit_card,10,109.98
o6,1,boleto,1,48.00
o7,1,boleto,1,32.50
o8,1,credit_card,1,1001.00
o9,1,debit_card,0,500.00
o11,1,boleto,1,7.25
"""

# Order 1 was reviewed twice and order 3 three times; one review is on two orders.
FILES["order_reviews"] = '''review_id,order_id,review_score,review_comment_title,review_comment_message,\
review_creation_date,review_answer_timestamp
r1,o1,5,,arrived quickly and well packed,2018-01-20 00:00:00,2018-01-21 08:00:00
r2,o1,1,,"broke on the first day,
""never again""",2018-01-20 00:00:00,2018-02-01 08:00:00
r3,o2,4,,"",2018-01-21 00:00:00,2018-01-22 08:00:00
r4,o3,3,ok,fine,2018-04-22 00:00:00,2018-04-23 08:00:00
r5,o3,3,,,2018-04-22 00:00:00,2018-04-25 08:00:00
r6,o3,3,,settled in the end after a long talk,2018-04-22 00:00:00,2018-04-24 08:00:00
r7,o4,5,,very good product and seller,2018-02-20 00:00:00,2018-02-21 08:00:00
r7,o5,5,,very good product and seller,2018-02-20 00:00:00,2018-02-21 08:00:00
r8,o6,1,,never arrived at my address at all,2018-03-20 00:00:00,2018-03-21 08:00:00
r9,o8,1,,canceled without a single word,2018-03-20 00:00:00,2018-03-21 08:00:00
r10,o10,4,,,2018-03-20 00:00:00,2018-03-21 08:00:00
'''

# "audio" is the same word in both languages; "pc_gamer" has no entry; p5 has no category.
FILES["products"] = """product_id,product_category_name,product_name_lenght,product_description_lenght,\
product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
p1,beleza,10,100,1,250,10,10,10
p2,audio,20,200,2,500,20,20,20
p3,pc_gamer,30,300,3,0,30,30,30
p4,beleza,10,100,1,250,10,10,10
p5,,,,,700,10,10,10
p6,audio,10,100,1,100,10,10,10
p7,beleza,10,100,1,300,10,10,10
"""

FILES["sellers"] = """seller_id,seller_zip_code_prefix,seller_city,seller_state
s1,01001,são paulo,SP
s2,01002,campinas,SP
s3,88888,curitiba,PR
"""

FILES["product_category_name_translation"] = "\ufeffproduct_category_name,product_category_name_english\r\n" \
    "beleza,beauty\r\naudio,audio\r\n"

LANDED_ROWS = {
    "customers": 11, "geolocation": 7, "orders": 11, "order_items": 13, "order_payments": 11,
    "order_reviews": 11, "products": 7, "sellers": 3, "product_category_name_translation": 2,
}
TYPED_ROWS = {
    "customers": 10, "geolocation": 5, "orders": 10, "order_items": 12, "payments": 10,
    "order_reviews": 7, "products": 7, "sellers": 3, "product_category_translation": 2,
}


def write_raw(folder: str) -> None:
    for name, text in FILES.items():
        with open(f"{folder}/{name}.csv", "w", encoding="utf-8", newline="") as file:
            file.write(text)
