"""Published views and the jobs that write them."""
