-- Balance of suppliers per nation, from a floor upwards.
SELECT n_name,
       count(*) AS n_suppliers,
       CAST(sum(CAST(s_acctbal AS DECIMAL(15,2))) AS DOUBLE) AS balance
FROM supplier
JOIN nation ON s_nationkey = n_nationkey
WHERE s_acctbal >= :floor
GROUP BY n_name;
