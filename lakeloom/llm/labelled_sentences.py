"""The labelled table of problem 10: sentences from which training documents are composed."""

EN = [
    "Diagnosis rests on examination, blood tests and imaging of the joints.", "The dose is 2.5 mg per day for 38 days.", "Dr. Lee of the ward told Mr. and Mrs. Poe to rest at 8 a.m. and again at 9 p.m. daily.",
    "The symptoms had faded by 10 p.m.", "The pack holds oats, tablets, wipes, etc.", "Wipes, tablets, etc. are in the pack.", "According to Poe et al., the dose was approx. 1.1 mg/kg vs. placebo.",
    "Samples were sent to St. Anna Laboratory on 3 Sept. 2029 for review.", "Version 2.0.7 of the protocol (approved on Sept. 12) excludes teenagers.", "The trial (cf. Fig. 2) enrolled 12 adults, e.g. people with gout.",
    "He lost 1.6 g of fluid, i.e. a normal amount.", "Write to desk.help@med.example or call ext. 40.12 about it.", "See www.med.example/guide-25.html for ver. 2.17 of the leaflet.", "K. Lee and Prof. Poe reviewed 26 charts from ward no. 12.",
    "Lt. Poe, Ph.D., left the ward at 6.30 p.m. to rest.", "Was it really gout?!", "Stop taking it now!!!", "The ache grew slowly... and then reached the knee.", "Only 3.5 % (n = 45) stopped, mostly because of a rash...",
    '"Please wash hands often!" said Dr. Lee at the end of the visit.', '"Is it safe to stop?" many people ask.', 'She said, "I have nausea. It comes at night." and asked about the heart.', 'He told us: "The pain in my back is gone."',
    '"Please keep warm."', "“Drink enough water.”", "How many tablets are enough: 1.5 or 2.0?", "The code B.26 in list ICD-10.83 stands for gout.", "It belongs to group B.7.", "Always rest before asking for a higher dose!",
    "The score rose from 2.5 to 7.25 (p < 0.05) after 32 hours.", "The liver plays a part (see Sect. 2.1).", "(See also Sect. 3.8 and Table A.2.)", "The U.S. trial ended in Jan. 2020 with no loss.", "In 2012, the clinic admitted 34 adults.", "The nurse thanked Dr. Lee.", "He met Mr. Poe.", "She saw Ann.",
]
VI = [
    "Người bệnh nên giữ ấm cơ thể và tái khám đúng hẹn.", "Thuốc được dùng với liều 8.5 mg mỗi ngày, kéo dài 54 giờ.", "Th.S Lê An nhắc rằng tỷ lệ 1:2.70 ở TX. Cồn Mây còn cao!!!", "TS.BS. Lê An cho biết gút có thể khởi phát từ mạch máu.",
    "Theo GS.TS. Lê An (Khoa Nội, BV. Đồi Sim), bản 2.0.64 của phác đồ không áp dụng.", "PGS. TS. Lê An và ThS. Trần Bình cùng theo dõi 29 người.", "Lịch tái khám là ngày 12.03.2027 tại P. 5, BV. Suối Ngọc.", "Cả nước có 1.651 ca, trong đó TP. Hồ Bạc chiếm 33.5%.",
    "Thực đơn nên có bí đỏ, cháo loãng, sữa, v.v.", "Cần kiêng đồ chua, rượu, v.v. để tránh mờ mắt.", "Liều là 0,5 mg/kg, tối đa 3.5 mg, chia 2 lần (xem H. 2.1).", "Bảng phân loại ICD-10.55 xếp gút vào nhóm B.34.", "Cơn đau tăng dần... rồi lan sang cơ hoành.",
    "Chỉ 3,5% (n = 26) ngừng thuốc, đa số vì phát ban đỏ...", 'Chị ấy nói: "Tôi hay chướng hơi. Đêm nào cũng vậy." rồi xin khám tim.', '"Tôi bị ho khan từ lâu!", một bệnh nhân kể lại.', '"Có cần mổ không?" là câu hỏi hay đặt ra.', "“Hãy uống đủ nước.”", '"Hãy giữ ấm cơ thể."',
    "Sao lại đau thế này?!", "Uống bao nhiêu là đủ: 1.5 hay 2.0 viên?", "Hãy tập thở mỗi sáng trước khi tăng liều!", "Gửi thư tới ban.docgia@yte.example hoặc gọi số nội bộ 40.12 để hỏi.", "Xem www.yte.example/bai-46.html cho bản 2.5.", "Sau 5 ngày, phần lớn bệnh nhân không còn đau.",
    "Ông N. V. Bình và bà Tr. Lan đến khám.", "Bác sĩ khuyên: “Đừng chủ quan.”", "Đ/c Lê An ở Q. 3 đã đến.", "Trong năm 2027, bệnh viện tiếp nhận hơn 64 ca.", "BS. Lê An hẹn khám lúc 8.30.", "Chị ấy gặp bác sĩ Lê An.", "Người bệnh khám ở Hồ Bạc.", "Bà về nhà cùng ông Lân.",
]
ZH = [
    "诊断依靠体格检查、血液化验和胃部的影像资料。", "药物Panizol每日用量为2.5毫克，连续服用17周。", "在加大剂量之前，请务必多喝温水！", "服用Panizol期间可以吃鲜姜吗？", "难道真的是痛风吗？！", "别再吃Panizol了！！！", "疼痛逐渐加重……随后扩散到心脏。",
    "资料见www.yixue.example/p68.html第2.25版。", "来信请寄bianji.desk@yixue.example，分机40.12。", "Dr. 林安与J. K.小组共随访了1.678万名老年人。", "每次服用3.5毫克Panizol，每日2次，详见图2.47。", "（参见第3.29节和附表A.2。）", "编码ICD-10.38中的B.85类对应痛风。", "到底该吃1.5片还是2.0片？",
    "比例为1:2.11，约合3.5%，仍高于2022年。", "2022年，医院收治了24多名患者。", "她说：“我有红色皮疹。昨晚更重。”随后离开了医院。", "“一定要减少饮酒！”林安医生叮嘱道。", "“能停用Panizol吗？”许多孕妇这样问。", "林安主任说：“痛风并不可怕。”", "患者说“腹胀已经好几天了”，随后接受了检查。", "之后再考虑使用Panizol。", "即使口干有所缓解，也不要自行停用Velora。", "首先要做的是充分休息，之后再考虑使用Kyamine。", "林安主任说：“痛风不难治。”", 
    "鲜姜搭配温水即可。", "“不要紧张。”护士说道。",
]
HEADS = {
    "en": ["# Diet in gout", "## Myths about gout (office workers)", "3. Outlook in gout (teenagers)", "Diagnosing gout among older adults", "**Causes of gout**", "Exercise for gout"],
    "vi": ["# Chẩn đoán gút", "## Điều trị gút (người cao tuổi)", "4. Chẩn đoán thủy đậu", "Tiên lượng của gút ở thanh thiếu niên", "**Nguyên nhân gây gút**", "Khi nào cần khám gút"],
    "zh": ["# 常用药物与痛风", "## 锻炼与痛风（慢性病患者）", "1. 护理痛风", "饮食与痛风：写给孕妇", "**引起痛风**", "诊断肾结石"],
}
ITEMS = {
    "en": ["A red rash at night", "Trembling hands most mornings, when the weather changes", "A dry mouth at night, at night.", "Numb fingers even at rest."],
    "vi": ["Ho khan kéo dài nặng dần", "Tim đập nhanh không đáp ứng với thuốc", "Chuột rút ban đêm lúc nghỉ ngơi.", "Sốt nhẹ về chiều thường gặp."],
    "zh": ["手脚麻木，仅见于一侧", "口干，休息时也有", "双腿浮肿，逐渐加重。", "吞咽疼痛，随季节复发。"],
}
ROWS = ["| Panizol | 2.4 mg |", "| Velora | 5.7 mg |"]
LABELS = {"en": ("Q: ", "A: "), "vi": ("Hỏi: ", "Đáp: "), "zh": ("问：", "答：")}
