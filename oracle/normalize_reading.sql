select *,
       array_to_string(list_filter([case when heart_rate >= 120 then 'HR_HIGH' end,
                      case when heart_rate >= 180 then 'CRITICAL_HR' end,
                      case when spo2 < 92 then 'SPO2_LOW' end,
                      case when systolic_bp >= 140 then 'BP_HIGH' end],
                     lambda x: x is not null), ',') as abnormal_flags,
       heart_rate >= 120 or spo2 < 92 or systolic_bp >= 140 as is_abnormal
from accepted
