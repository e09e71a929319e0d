SELECT school_year, region, count(DISTINCT school_id) AS num_schools
FROM school_years
WHERE school_management = 'DepEd'
GROUP BY school_year, region
