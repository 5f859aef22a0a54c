"""firegrid: open-fire emission inventories as Spark DataFrame jobs."""
