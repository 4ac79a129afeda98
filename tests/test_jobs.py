"""Both pipelines from CSV files to stored tables."""

from tallyloom.plans import jobs, sales
from tallyloom.sources import files
from tallyloom.sources.schemas import SALES


def write(folder, name, header, *lines):
    (folder / f"{name}.csv").write_text("\n".join([header, *lines]) + "\n")


def test_sales(spark, tmp_path, rows):
    write(tmp_path, "sales_transactions", "TransactionID,OrderID,CustomerID,ProductID,SalesRepID,TransactionDate,Quantity,UnitPrice,Discount,PaymentMethod,ReturnFlag",
          "T1,O1,C1,P1,R1,2024-01-05,10,250.00,0.10,Wire Transfer,N", "T2,O2,C1,P1,R1,2024-04-05,1,100.00,0.00,PayPal,Y", "T3,O3,C1,P1,R1,2024-04-06,2,100.00,0.50,PayPal,")
    write(tmp_path, "customers", "CustomerID,CustomerName,Email,Phone,Segment,Region,Country,State,City,AccountOpenDate,CreditLimit,PreferredPayment,IsActive",
          "C1,Ann,a@x,1,SMB,North,US,CA,X,2023-01-05,80000,PayPal,Y")
    write(tmp_path, "products", "ProductID,ProductName,Category,SubCategory,Brand,CostPrice,MSRP,LaunchDate,IsActive,WarrantyMonths,MinStock,MaxStock",
          "P1,Pump,Hardware,A,X,100.00,260.00,2020-01-01,Y,12,1,2")
    write(tmp_path, "sales_reps", "SalesRepID,RepName,Email,Region,Territory,HireDate,BaseSalary,CommissionRate,Manager,IsActive,YTDQuota",
          "R1,Rob,r@x,North,N1,2020-01-01,1,0.08,M,Y,2000")
    write(tmp_path, "regional_targets", "Region,Quarter,Year,RevenueTarget,UnitTarget,NewCustomerTarget,RetentionTarget",
          "North,Q1,2024,2250,5,1,0.85")
    out = jobs.run_sales(spark, jobs.Layout(str(tmp_path), storage=str(tmp_path / "tables")))
    assert {name: df.count() for name, df in out.items()} == {
        "staging_valid_transactions": 1, "staging_returned_orders": 2, "enriched_transactions": 1,
        "customer_kpi_report": 1, "product_performance": 1, "rep_commission_report": 1, "regional_dashboard": 1,
        "returned_orders_flagged": 2,
    }
    source = files.read_csv(spark, str(tmp_path / "sales_transactions.csv"), SALES["sales_transactions"])
    assert rows(out["staging_valid_transactions"]) == rows(sales.stage_valid(source))
    assert rows(out["staging_returned_orders"]) == rows(sales.split_returns(source)[1])
    assert out["staging_returned_orders"].columns == source.columns
    board = out["regional_dashboard"].first()
    assert (board.RevenueAttainmentPct, board.TargetStatus, float(board.TotalCommission)) == (100.0, "Target Met", 270.0)
    assert spark.table("default.enriched_transactions").first().AccountAgeDays == 365


def test_retail_with_a_missing_source(spark, tmp_path, rows):
    write(tmp_path, "transaction", "transactionid,creditcardnumber,customerid,transactiondate,creditcardtype,locationid,productid,purchaseprice",
          "1,4000,1,2020-01-01,Visa,1,7,3", "2,4000,1,2020-01-05,Visa,0,7,4", "3,5000,2,2020-01-05,Discover,9,7,5")
    write(tmp_path, "units_2020", "productid,brandid,containertype,locationid,purchasedate", "7,70,Keg,1,2019-12-31")
    write(tmp_path, "location", "locationid,locationname,streetaddress,city,state,zipcode", "0,LOST,,,,", "1,Main,S,C,CA,95819")
    write(tmp_path, "geolocation", "locationid,latitude,longitude,location", "0,0,0,POINT(0 0)", "1,38.5,-121.4,POINT(-121.4 38.5)")
    write(tmp_path, "review", "customerid,brandid,starrating,reviewdate,review", "1,70,5,2020-02-01,")
    out = jobs.run_retail(
        spark, jobs.Layout(str(tmp_path), storage=str(tmp_path / "tables"), files={"stock": "units_2020.csv"})
    )
    assert "gold_customer_review_engagement" not in out and "silver_review" in out
    fact = out["fact_transaction"]
    assert rows(fact, "Transaction_ID", "Days_Since_Last_Purchase", "Time_on_Shelf", "locationname") == [
        (1, 0, 1, "Main"), (2, 4, 5, None), (3, 0, 5, None),
    ]
    assert rows(out["gold_creditcard_revenue_summary"]) == [("Discover", 5.0, 4.0), ("Visa", 7.0, 5.0)]
    assert rows(out["gold_daily_transaction_summary"], "transaction_count") == [(1,), (2,)]
    assert rows(out["dim_creditcard_type"]) == [("Discover", 1), ("Visa", 2)]
    assert out["dim_date"].count() == 2 and out["bronze_transaction"].count() == 3


def test_retail_with_everything(spark, tmp_path, rows):
    write(tmp_path, "transaction", "transactionid,creditcardnumber,customerid,transactiondate,creditcardtype,locationid,productid,purchaseprice",
          "1,4000,1,2020-01-01,Visa,1,7,3", "2,4000,1,2021-01-05,Visa,1,8,4", "3,5000,2,2021-02-05,Discover,1,7,12")
    write(tmp_path, "units", "productid,brandid,containertype,locationid,purchasedate", "7,70,Keg,1,2019-12-31", "8,80,Can,1,2019-12-31")
    write(tmp_path, "location", "locationid,locationname,streetaddress,city,state,zipcode", "0,LOST,,,,", "1,Main,S,C,CA,95819")
    write(tmp_path, "geolocation", "locationid,latitude,longitude,location", "0,0,0,POINT(0 0)", "1,38.5,-121.4,POINT(-121.4 38.5)")
    write(tmp_path, "review", "customerid,brandid,starrating,reviewdate,review", "1,70,5,2020-02-01,good", "1,80,2,2020-02-02,", "2,70,3,2020-02-03,fine")
    write(tmp_path, "customer", "customerid,firstname,lastname,fullname,streetaddress,city,state,zipcode,email,phonenumber,firstpurchasedate,subscribedtoemaillist,gender",
          "1,Ann,A,Ann A,S,C,CA,95819,a@x,1,01/02/2020,Y,F", "2,Bob,B,Bob B,S,C,CA,95819,b@x,2,bad,N,M", "3,Cy,C,Cy C,S,C,NV,89501,c@x,3,,N,M")
    write(tmp_path, "brands_2020", "key,brandname,description,city,state,website,facebookpage,twitter", "70,Old,\tgood,C,CA,,f,t", "80,New,best,C,CA,w,,t")
    write(tmp_path, "customer_geo", "lon,lat,customerid", "-121.4,38.5,1", "-110.0,38.5,2")
    (tmp_path / "trends").mkdir()
    (tmp_path / "trends" / "2018.csv").write_text("Category: All categories\n\nWeek,interest\n2018-01-07,54\nnot a line\n")
    (tmp_path / "trends" / "2019.csv").write_text("Category: All categories\n\nWeek,interest\n2019-01-06,7\n")
    layout = jobs.Layout(
        str(tmp_path), storage=str(tmp_path / "tables"), files={"stock": "units.csv", "brand": "brands_2020.csv"},
        renames={"brand": {"key": "brandid"}}, trends="trends/*.csv",
    )
    out = jobs.run_retail(spark, layout)
    assert rows(out["silver_brand"], "brandid", "website", "facebookpage") == [
        (70, "http://www.google.com/search?q=Old", "f"), (80, "w", "http://www.google.com/search?q=New"),
    ]
    assert rows(out["gold_monthly_sales"], "Sales", "RunTot_Sales") == [(3.0, 3.0), (4.0, 7.0), (12.0, 19.0)]
    assert rows(out["gold_yearly_to_date"], "Year", "Customers", "Revenue") == [(2020, 1, 3.0), (2021, 2, 16.0)]
    assert rows(out["gold_brand_revenue_share"], "Brand", "Share_of_Revenue_Label") == [("New", "25.0%"), ("Old", "75.0%")]
    assert rows(out["gold_reviews"], "Review_ID", "brandname", "description", "cust_firstpurchasedate")[0][:3] == (1, "Old", "good")
    assert rows(out["gold_rating_cross_tab"], "brandname", "Rating_2", "Rating_3", "Rating_5") == [("New", 1, 0, 0), ("Old", 0, 1, 1)]
    assert out["gold_brand_rating"].count() == 2
    assert rows(out["gold_engagement_rate"]) == [(2, 3, "66.6%")]
    assert rows(out["gold_trade_area"], "customerid", "storeid", "CoveringStores") == [(1, 1, "1"), (2, 1, None)]
    assert rows(out["gold_trade_area_buckets"]) == [(" < 5 Miles", 1), (" > 5 Miles", 1)]
    assert out["bronze_trend"].columns == ["Week", "interest", "FileName"] and out["silver_trend"].count() == 2
    assert rows(out["bronze_trend_rejects"]) == [("not a line", "2018.csv")]
    assert out["gold_customer_review_engagement"].count() > 0 and out["silver_customer"].count() == 3 and out["silver_review"].count() == 3
