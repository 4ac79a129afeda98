"""Declared columns of the CSV inputs (fixed values)."""

from pyspark.sql.types import DateType, IntegerType, StructField, StructType

# Trend exports: what stands above the header, and the data below it.
TREND_TITLE = "Category: .*"
TREND = StructType([StructField("Week", DateType()), StructField("interest", IntegerType())])

SALES = {
    "sales_transactions": (
        "TransactionID string, OrderID string, CustomerID string, ProductID string, SalesRepID string, "
        "TransactionDate date, Quantity int, UnitPrice decimal(18,2), Discount decimal(4,2), PaymentMethod string, "
        "ReturnFlag string"
    ),
    "customers": (
        "CustomerID string, CustomerName string, Email string, Phone string, Segment string, Region string, "
        "Country string, State string, City string, AccountOpenDate date, CreditLimit int, PreferredPayment string, "
        "IsActive string"
    ),
    "products": (
        "ProductID string, ProductName string, Category string, SubCategory string, Brand string, "
        "CostPrice decimal(18,2), MSRP decimal(18,2), LaunchDate date, IsActive string, WarrantyMonths int, "
        "MinStock int, MaxStock int"
    ),
    "sales_reps": (
        "SalesRepID string, RepName string, Email string, Region string, Territory string, HireDate date, "
        "BaseSalary int, CommissionRate decimal(6,4), Manager string, IsActive string, YTDQuota int"
    ),
    "regional_targets": (
        "Region string, Quarter string, Year int, RevenueTarget int, UnitTarget int, NewCustomerTarget int, "
        "RetentionTarget decimal(4,2)"
    ),
}

RETAIL = {
    "transaction": (
        "transactionid int, creditcardnumber bigint, customerid int, transactiondate date, creditcardtype string, "
        "locationid int, productid int, purchaseprice double"
    ),
    "customer": (
        "customerid int, firstname string, lastname string, fullname string, streetaddress string, city string, "
        "state string, zipcode string, email string, phonenumber string, firstpurchasedate string, "
        "subscribedtoemaillist string, gender string"
    ),
    "customer_geo": "customerid int, lat double, lon double",
    "stock": "productid int, brandid int, containertype string, locationid int, purchasedate date",
    "review": "customerid int, brandid int, starrating int, reviewdate date, review string",
    "brand": (
        "brandid int, brandname string, description string, city string, state string, website string, "
        "facebookpage string, twitter string"
    ),
    "geolocation": "locationid int, latitude double, longitude double, location string",
    "location": "locationid int, locationname string, streetaddress string, city string, state string, zipcode string",
}
