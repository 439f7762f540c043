"""Point-in-time features on entity x occasion panels, as Spark DataFrame functions."""
