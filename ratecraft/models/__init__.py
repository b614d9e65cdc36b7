"""Rating predictors trained by Spark jobs."""
